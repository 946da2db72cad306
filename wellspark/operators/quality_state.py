"""The quality report (Q1-Q20) from states that add up: a new load is checked by reading that load alone.

Every load of a table leaves two small things behind. One row of counters (rows, and
bad values per check), of which a table's totals are the sums. And, for uniqueness (Q3,
Q9), its key counts: (bucket, key, n), folders by hash of the key. How many keys a load
makes duplicates is told by joining its key counts with those of the loads before, so
duplicates across loads are found without their rows. The commute rule (Q19) depends
on the employee's mode, which may change: a load of checks keeps, per employee,
how many of its distances exceed either limit, and the report joins these with the
employees of the day.

A table's state is a versioned table (``sources.versions``): counters and key counts of
a load become current in one commit, under the load's number, so a load that is
absorbed again changes nothing. Two loads absorbed at a time would both count the keys
against the same state; the second finds a newer version and counts again.
Key counts hold one row per key and load until ``compact`` adds them up.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import rules
from ..sources import versions
from . import quality as Q
from .config import Params

COUNTERS, KEYS, OVER = "counters", "keys", "over"
KEY_BUCKETS = 64
_RETRIES = 20


def _key_counts(df: DataFrame, key: str, buckets: int) -> DataFrame:
    """(bucket, key, n); a NULL key is a key."""
    counts = df.groupBy(F.col(key).alias("key")).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("bucket", F.pmod(F.xxhash64(F.col("key").isNull(), "key"), F.lit(buckets)).cast("int"))


def over_limits(checks: DataFrame, params: Params) -> DataFrame:
    """(employee_id, over_walk, over_other): how many distances of an employee exceed either limit."""
    walk, other = F.lit(params.max_distance_walk_run_km), F.lit(params.max_distance_bike_scooter_km)
    far = checks.where(F.col("distance_km") > F.least(walk, other)).where(F.col("employee_id").isNotNull())
    return far.groupBy("employee_id").agg(F.count_if(F.col("distance_km") > walk).alias("over_walk"),
                                          F.count_if(F.col("distance_km") > other).alias("over_other"))


def rule_violations(over: DataFrame, employees: DataFrame) -> DataFrame:
    """One row: how many checks break the rule, given the employees' modes (K1 counted)."""
    walks = rules.is_walk_run_mode(F.col("commute_mode"))
    per = F.when(walks, F.col("over_walk")).when(~walks, F.col("over_other"))
    joined = over.join(employees.select("employee_id", "commute_mode"), "employee_id")
    return joined.agg(F.coalesce(F.sum(per), F.lit(0)).alias(Q.RULE_CHECK.key))


class TableState:
    """Counters and key counts of one table's loads."""

    def __init__(self, spark: SparkSession, root: str, checks: tuple[Q.Check, ...], key: str | None, buckets: int = KEY_BUCKETS):
        self.spark, self.root, self.checks, self.key, self.buckets = spark, root.rstrip("/"), checks, key, buckets
        self.counted = [c for c in checks if c.kind == "count_if"]
        self.duplicates = [c.key for c in checks if c.kind == "dup_keys"]

    def _write(self, df: DataFrame, folder: str, partition_by: str | None = None) -> DataFrame:
        path = f"{self.root}/{folder}"
        writer = df.write.mode("overwrite")
        (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)
        return versions.read_folders(self.spark, self.root, [folder], df.schema)

    def absorb(self, df: DataFrame, load: int, replace: bool = False, extra: dict[str, DataFrame] | None = None) -> bool:
        """Add one load (``replace``: it takes the place of all before); False if it was absorbed already.

        ``extra`` are further outputs that become current with it.
        """
        for _ in range(_RETRIES):
            now = versions.current(self.spark, self.root) or versions.Version()
            if now.holds(("load", load)):
                return False
            write = versions.new_write(f"load-{load}-{now.number}")
            folder = {o: f"{write}/{versions.OUTPUT}={o}" for o in (COUNTERS, KEYS, *(extra or {}))}
            counters = df.agg(F.count(F.lit(1)).alias("_rows"),
                              *[F.count_if(F.expr(c.predicate)).alias(c.key) for c in self.counted])
            schemas = {}
            if self.duplicates:
                new = self._write(_key_counts(df, self.key, self.buckets), folder[KEYS], "bucket")
                schemas[KEYS] = new.schema
                known = None if replace else versions.read(self.spark, self.root, KEYS, now)
                counters = Q._merge_one_row(counters, self._made_duplicates(new, known))
            written = {o: self._write(x, folder[o]) for o, x in {COUNTERS: counters, **(extra or {})}.items()}
            schemas |= {o: x.schema for o, x in written.items()}
            try:
                versions.commit(self.spark, self.root, {o: [folder[o]] for o in schemas}, schemas,
                                remove=None if replace else (), token=("load", load), based_on=now.number)
                return True
            except versions.CommitConflict:  # another load came first: count against it
                continue
        raise versions.CommitConflict(f"{self.root}: other loads kept coming first")

    def _made_duplicates(self, new: DataFrame, known: DataFrame | None) -> DataFrame:
        """One row: keys that are duplicates with this load and were none before it."""
        if known is None:
            made = new.where("n > 1")
        else:
            before = (known.join(new.select(F.col("bucket").alias("_b"), F.col("key").alias("_k")),
                                 (F.col("bucket") == F.col("_b")) & F.col("key").eqNullSafe(F.col("_k")), "left_semi")
                      .groupBy(F.col("bucket").alias("_b"), F.col("key").alias("_k")).agg(F.sum("n").alias("before")))
            both = new.join(before, (F.col("bucket") == F.col("_b")) & F.col("key").eqNullSafe(F.col("_k")), "left")
            held = F.coalesce("before", F.lit(0))
            made = both.where((held <= 1) & (held + F.col("n") > 1))
        return made.agg(*[F.count(F.lit(1)).alias(c) for c in self.duplicates])

    def metrics(self) -> DataFrame | None:
        """The table's one-row metrics, as ``quality.table_metrics`` computes them from all rows; None without loads."""
        found = versions.read(self.spark, self.root, COUNTERS)
        if found is None:
            return None
        return found.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in found.columns])

    def duplicate_keys(self) -> DataFrame:
        """V1 across loads: (key, n_rows) of all keys that repeat or are NULL, without reading any load's rows."""
        return (versions.read(self.spark, self.root, KEYS).groupBy("bucket", "key").agg(F.sum("n").alias("n_rows"))
                .where("n_rows > 1 OR key IS NULL").select("key", "n_rows"))

    def compact(self) -> None:
        """Add up the key counts and the counters of all loads so far; later loads go on from there."""
        now = versions.current(self.spark, self.root)
        if now is None:
            return
        write = versions.new_write()
        outputs = {COUNTERS: self.metrics()}
        if self.duplicates:
            keys = versions.read(self.spark, self.root, KEYS, now)
            outputs[KEYS] = keys.groupBy("bucket", "key").agg(F.sum("n").alias("n")).select(*keys.columns)
        if OVER in now.schemas:
            over = versions.read(self.spark, self.root, OVER, now)
            outputs[OVER] = over.groupBy("employee_id").agg(*[F.sum(c).alias(c) for c in over.columns[1:]])
        folder = {o: f"{write}/{versions.OUTPUT}={o}" for o in outputs}
        for o, df in outputs.items():
            self._write(df, folder[o], "bucket" if o == KEYS else None)
        versions.commit(self.spark, self.root, {o: [f] for o, f in folder.items()}, {o: df.schema for o, df in outputs.items()},
                        remove=None, based_on=now.number)
        versions.vacuum(self.spark, self.root)


class QualityState:
    """States of the three checked tables and the report made from them.

    Employees are replaced by every load, activities and distance checks grow.
    """

    def __init__(self, spark: SparkSession, root: str, params: Params = Params()):
        self.spark, self.params = spark, params
        root = root.rstrip("/")
        self.employees = TableState(spark, f"{root}/employees", Q.EMPLOYEE_CHECKS, "employee_id")
        self.activities = TableState(spark, f"{root}/activities", Q.ACTIVITY_CHECKS, "activity_id")
        self.checks = TableState(spark, f"{root}/checks", Q.CHECKS_TABLE_CHECKS, None)

    def absorb_employees(self, df: DataFrame, load: int) -> bool:
        return self.employees.absorb(df, load, replace=True)

    def absorb_activities(self, df: DataFrame, load: int) -> bool:
        return self.activities.absorb(df, load)

    def absorb_checks(self, df: DataFrame, load: int) -> bool:
        return self.checks.absorb(df, load, extra={OVER: over_limits(df, self.params)})

    def report(self, employees: DataFrame) -> DataFrame:
        """Q20 of all that was absorbed; ``employees`` are today's, for the commute rule."""
        emp = self.employees.metrics()
        if emp is None:
            raise RuntimeError("no employees were absorbed")
        act, chk = self.activities.metrics(), self.checks.metrics()
        if chk is not None:
            chk = Q._merge_one_row(chk, rule_violations(versions.read(self.spark, self.checks.root, OVER), employees))
            chk = Q.commute_rows(chk, params=self.params)
        if act is not None:
            act = Q.activity_rows(act, params=self.params)
        return Q.assemble_report(self.spark, Q.employee_rows(emp, params=self.params), act, chk)
