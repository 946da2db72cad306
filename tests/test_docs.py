"""The README's Python example stays valid: it compiles and only uses names that exist."""

import ast
import importlib
import os
import re

from tests.conftest import ROOT


def test_readme_example_compiles_and_imports_exist():
    text = open(os.path.join(ROOT, "README.md"), encoding="utf-8").read()
    blocks = re.findall(r"```python\n(.*?)```", text, flags=re.S)
    assert blocks, "README has a python example"
    for code in blocks:
        tree = ast.parse(code)
        aliases = {}
        for node in ast.walk(tree):
            if isinstance(node, ast.ImportFrom) and node.module and node.module.startswith("wellspark"):
                mod = importlib.import_module(node.module)
                for a in node.names:
                    obj = getattr(mod, a.name, None)
                    if obj is None:
                        obj = importlib.import_module(f"{node.module}.{a.name}")
                    aliases[a.asname or a.name] = obj
        for node in ast.walk(tree):  # module.attr used in the example must exist
            if isinstance(node, ast.Attribute) and isinstance(node.value, ast.Name) and node.value.id in aliases:
                assert hasattr(aliases[node.value.id], node.attr), f"{node.value.id}.{node.attr}"
