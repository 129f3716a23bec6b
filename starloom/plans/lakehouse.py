"""The whole run: silver batch, four dimensions, fact; first load and increments alike."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from functools import partial, reduce
from operator import and_

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from starloom.operators.lookup import BROADCAST_BYTES, BROADCAST_ROWS, Size, measure, star_lookup
from starloom.operators.upsert import require_unique, upsert
from starloom.plans.dimension import apply_members, stage_members, stage_unknown
from starloom.plans.fact import build_fact, key_lookups, to_grain
from starloom.plans.marts import key_totals
from starloom.plans.silver import to_silver
from starloom.schemas import BRONZE, DATE, DIMENSIONS, FACT, FACT_KEYS, SILVER, DimSpec, conform, same
from starloom.session import new_folder
from starloom.sources.files import read_parquet
from starloom.sources.tables import CatalogTable, drop_folder, hash_bucket, range_bucket, write_spread

ON_DUPLICATE = ("raise", "aggregate", "keep")

# Lines of an increment up to which older lines of their combinations are searched for by a join.
SEARCHED_LINES = 1_000_000


class Lakehouse:
    """Silver and gold tables under one folder, external tables of the catalog.

    Whether a table is built or refreshed follows from what the folder holds,
    not from a flag that could disagree with it. Silver is partitioned by a hash of
    the date id, which needs no table and no order of ids, and by batch; the fact by ranges of
    ``dates_per_part`` date keys, which grow with arrival. Both are parts of the merge
    key, so an increment reads and rewrites the partitions of its own dates and leaves all others unread.
    With ``fact_buckets`` the fact also lies in that many buckets by its four keys, so that a merge shuffles
    the increment alone. A bucket is one task's, so a large fact needs some thousands; they are even,
    as such a fact has one row for each combination of keys (``on_duplicate="keep"`` is refused).
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        silver_schema: str = "silver",
        gold_schema: str = "gold",
        dates_per_part: int = 64,
        silver_buckets: int = 64,
        totals: Mapping[str, Sequence[str]] | None = None,
        fact_buckets: int = 0,
    ):
        self.spark, self.root = spark, root.rstrip("/")
        self.silver_schema, self.gold_schema = silver_schema, gold_schema
        self.silver_path = f"{self.root}/silver/sales"
        self._measured: dict[str, Size] = {}
        self.bucket, bucket_of = f"date_hash_{silver_buckets}", hash_bucket(DATE.source_id, silver_buckets)
        self.lines = CatalogTable(
            spark,
            f"{silver_schema}.sales_lines",
            self.silver_path,
            SILVER,
            {self.bucket: (IntegerType(), bucket_of), "batch": (StringType(), F.col("batch"))},
            DATE.source_id,
        )
        self.dims = {s.name: CatalogTable(spark, f"{gold_schema}.{s.table}", f"{self.root}/gold/{s.table}", s.schema) for s in DIMENSIONS}
        self.fact_part, self.fact_part_of = f"date_keys_by_{dates_per_part}", range_bucket("dim_date_key", dates_per_part)
        self.fact = CatalogTable(
            spark, f"{gold_schema}.fact_sales", f"{self.root}/gold/fact_sales", FACT,
            {self.fact_part: (IntegerType(), self.fact_part_of)}, "dim_date_key", (FACT_KEYS, fact_buckets) if fact_buckets else None,
        )

        # Sums per some keys, the date's among them, kept up to date with the fact and by the same partitions.
        self.totals, self._total_keys = {}, dict(totals or {})
        for name, keys in self._total_keys.items():
            if "dim_date_key" not in keys:
                raise ValueError(f"{name} needs dim_date_key, by which the fact changes")
            schema = StructType([*(FACT[k] for k in keys), FACT["Revenue"], FACT["Units_Sold"], StructField("lines", LongType())])
            self.totals[name] = CatalogTable(
                spark, f"{gold_schema}.{name}", f"{self.root}/gold/{name}", schema, {self.fact_part: (IntegerType(), self.fact_part_of)}, "dim_date_key"
            )

    # -- silver ---------------------------------------------------------------

    def write_silver(self, bronze: DataFrame, batch: str | None = None) -> DataFrame:
        """Rebuild silver from all of bronze, or write one batch of it, and read back what was written.

        Writing a batch again replaces that batch alone.
        """
        with self._incoming(bronze, batch):
            self.lines.put(None if batch is None else F.col("batch") == batch)
        return self.silver(batch)

    @contextmanager
    def _incoming(self, bronze: DataFrame, batch: str | None) -> Iterator[DataFrame]:
        """Silver rows of one batch, written aside: they do not count yet."""
        name = "all" if batch is None else batch
        if not re.fullmatch(r"[\w-]+", name):
            raise ValueError(f"batch names a folder; use letters, digits, _ and - instead of {name!r}")
        with self._staged(bronze.withColumn("batch", F.lit(name))) as rows:
            yield rows

    @contextmanager
    def _staged(self, bronze: DataFrame) -> Iterator[DataFrame]:
        """Silver rows of the batches that ``batch`` names, written aside. Rows move as bronze: what silver derives would make the shuffle larger."""
        bucket_of = self.lines.parts[self.bucket][1]
        together = conform(bronze, BRONZE, "batch").withColumn(self.bucket, bucket_of).hint("rebalance", *self.lines.parts)
        with self.lines.staged(to_silver(together, "batch"), laid_out=True) as rows:
            yield rows

    def silver(self, batch: str | None = None) -> DataFrame:
        """All of silver, or one batch, of which only its own folders are listed."""
        rows = self.lines.read("batch")
        return (rows if batch is None else rows.where(F.col("batch") == batch)).drop("batch")

    # -- gold -----------------------------------------------------------------

    def refresh_dimension(self, spec: DimSpec, silver: DataFrame) -> None:
        """Build the dimension or refresh it; nothing is written if the batch changes nothing."""
        self._change_dimension(spec, silver, stage_members, F.col("changed"))

    def infer_members(self, spec: DimSpec, silver: DataFrame) -> None:
        """Give the ids of ``silver`` that are no members yet a key, without attributes; a later refresh fills those in."""
        self._change_dimension(spec, silver, stage_unknown, F.lit(True))

    def _change_dimension(self, spec: DimSpec, silver: DataFrame, stage: Callable, changes: Column) -> None:
        table = self.dims[spec.name]
        existing = table.read()
        path = new_folder(self.spark, f"members-{spec.name}")
        try:
            staged = stage(spec, silver, existing, path)
            if not table.exists() or not staged.where(changes).isEmpty():
                table.replace(apply_members(spec, staged, existing))
                self._measured.pop(spec.name, None)
        finally:
            drop_folder(self.spark, path)

    def refresh_dimensions(self, silver: DataFrame) -> None:
        self._each_dimension(self.refresh_dimension, silver)

    def _each_dimension(self, change: Callable, silver: DataFrame) -> None:
        """Change all dimensions; they do not depend on each other, so their jobs run side by side."""
        inherit = inheritable_thread_target(self.spark)
        with ThreadPoolExecutor(len(DIMENSIONS)) as pool:
            runs = [pool.submit(inherit(change), spec, silver) for spec in DIMENSIONS]
            for run in runs:
                run.result()

    def dimensions(self) -> dict[str, DataFrame]:
        return {name: table.read() for name, table in self.dims.items()}

    def _sizes(self) -> list[Size]:
        """Sizes of the dimensions, whose ids are checked to be unique; measured again once they change, in one job for all."""
        stale = {n: lookup for n, lookup in zip(self.dims, key_lookups(self.dimensions())) if n not in self._measured}
        if stale:
            self._measured |= dict(zip(stale, measure(list(stale.values()))))
        return [self._measured[n] for n in self.dims]

    def load_fact(self, silver: DataFrame, on_duplicate: str = "raise", rebuild: bool = False, infer: bool = False) -> None:
        """Build the fact from ``silver``, or merge it in as an increment that replaces what it matches.

        ``load_batch`` is the way for lines of one combination that may come in
        several batches; here an increment holds all lines of its combinations. Several lines for one combination of keys raise, are summed
        (``aggregate``) or stay as they are (``keep``; a merge then replaces all
        rows of the combination). A line whose member was not known yet sits
        under a NULL key that no later merge can find again: pass all of silver
        with ``rebuild`` once the dimension has caught up. With ``infer`` such members get
        their keys first, so that a later refresh of the dimension is all that it takes.
        """
        self._check_mode(on_duplicate)
        if infer:
            self._each_dimension(self.infer_members, silver)
        rows = build_fact(silver, self.dimensions(), sizes=self._sizes())
        if on_duplicate == "aggregate":
            rows = to_grain(rows)
        if rebuild or not self.fact.exists():
            self.fact.replace(rows, partial(require_unique, keys=FACT_KEYS) if on_duplicate == "raise" else None)
            self._refresh_totals(None)
            return
        self.merge_fact(rows, unique=on_duplicate != "raise")

    def merge_fact(self, rows: DataFrame, unique: bool = False, touched: DataFrame | None = None) -> None:
        """Upsert fact rows on the four keys, within the partitions that they fall into.

        The rows are written down first, since they are needed several times. ``touched``
        holds further keys to replace, which may have no row any more. The
        partition numbers that reach the driver are as few as folders of the table.
        """
        path = new_folder(self.spark, "fact-increment")
        try:
            write_spread(rows, path)
            rows = read_parquet(self.spark, path, FACT)
            if not unique:
                require_unique(rows, FACT_KEYS)
            keys = rows.select(FACT_KEYS)
            keys = keys if touched is None else keys.unionByName(touched.select(FACT_KEYS))
            parts = [r[0] for r in keys.select(self.fact_part_of.alias("part")).distinct().collect()]
            if parts:
                within = F.col(self.fact_part).isin(parts)
                if self.fact.bucket_keys:
                    merged = self.fact.merged(rows, keys, within)
                else:
                    target = self.fact.read(self.fact_part).where(within).drop(self.fact_part)
                    if self._sizes()[DIMENSIONS.index(DATE)].fits(BROADCAST_ROWS, BROADCAST_BYTES):
                        # Keys of dates that the target lacks match nothing; there are no more dates than members.
                        dates = F.broadcast(target.select("dim_date_key").distinct())
                        keys = keys.alias("key").join(dates.alias("date"), same("key.dim_date_key", "date.dim_date_key"), "left_semi")
                    merged = upsert(target, rows, FACT_KEYS, unique=True, touched=keys)
                with self.fact.staged(merged, laid_out=bool(self.fact.bucket_keys)):
                    self.fact.put(within)
                self._refresh_totals(within)
        finally:
            drop_folder(self.spark, path)

    def _refresh_totals(self, within: Column | None) -> None:
        """Sum the fact's partitions that have changed once more, for each table of totals.

        Adding differences would read no less, since a merge reads and writes these partitions whole,
        and would count a batch twice, or never, if a crash came between the fact and its totals.
        """
        for name, table in self.totals.items():
            missing = within is not None and not table.exists()
            rows = self.fact.read(self.fact_part)
            rows = rows if within is None or missing else rows.where(within)
            with table.staged(key_totals(rows, self._total_keys[name])):
                table.put(None if missing else within)

    def _check_mode(self, on_duplicate: str) -> None:
        if on_duplicate not in ON_DUPLICATE:
            raise ValueError(f"on_duplicate must be one of {ON_DUPLICATE}")
        if on_duplicate == "keep" and self.fact.bucket_keys:
            # All lines of one combination would be a single task's.
            raise ValueError("a fact in buckets has one row for each combination of keys: it cannot keep several")

    # -- runs -----------------------------------------------------------------

    def load_batch(self, bronze: DataFrame, batch: str, on_duplicate: str = "raise") -> None:
        """Take one bronze batch through all layers; loading it twice equals loading it once.

        The fact then is what all of silver gives, however its lines came in batches:
        every combination of keys that the batch touches is computed anew from all of
        its lines. Silver changes last, so a refused batch leaves silver and fact as they were.
        """
        with self._incoming(bronze, batch) as new:
            self._load(new, [batch], on_duplicate)

    def load_files(self, bronze: DataFrame, on_duplicate: str = "raise", expected: int | None = None) -> None:
        """Like ``load_batch`` for rows of many files, whose paths are in the column ``file_path``.

        Each file is a batch of its own, named by a digest of its path, so it makes no
        difference which files come together, nor whether some come again. Another number of rows than
        ``expected`` raises, and leaves silver and fact as they were.
        """
        with self._staged(bronze.withColumn("batch", F.md5(F.col("file_path").cast("binary")))) as new:
            if expected is not None and (rows := new.count()) != expected:
                raise ValueError(f"the files have changed: {rows} rows instead of {expected}")
            # As many names as files that come in now.
            self._load(new, [r["batch"] for r in new.select("batch").distinct().collect()], on_duplicate)

    def _load(self, new: DataFrame, names: list[str], on_duplicate: str) -> None:
        self._check_mode(on_duplicate)
        here = F.col("batch").isin(names) if names else F.lit(False)
        present = self.lines.read(self.bucket, "batch")
        kept = present.where(~here)
        refresh = self.fact.exists()
        self.refresh_dimensions(new if refresh else kept.unionByName(new))
        if refresh:
            self._refresh_grains(new, present.where(here), kept, on_duplicate)
        else:
            self.load_fact(kept.unionByName(new), on_duplicate, rebuild=True)
        if names:
            self.lines.put(here)
        self.register()

    def lines_of(self, touched: DataFrame, silver: DataFrame) -> DataFrame:
        """The rows of ``silver`` (with its bucket) whose four ids are in ``touched``, from the buckets that hold them.

        No more bucket numbers than ``silver_buckets`` reach the driver; the planner lists only their folders.
        """
        ids = [spec.source_id for spec in DIMENSIONS]
        bucket_of = self.lines.parts[self.bucket][1]
        buckets = [r[0] for r in touched.select(bucket_of.alias("bucket")).distinct().collect()]
        within = F.col(self.bucket).isin(buckets) if buckets else F.lit(False)
        match = reduce(and_, [same(f"silver.{c}", f"touched.{c}") for c in ids])
        return silver.where(within).alias("silver").join(touched.alias("touched"), match, "left_semi")

    def _refresh_grains(self, new: DataFrame, gone: DataFrame, kept: DataFrame, on_duplicate: str) -> None:
        """Compute the fact rows of all combinations of ids in ``new`` and in ``gone``, the lines it replaces, anew from ``new`` and ``kept``.

        New lines count by themselves, so only older lines are looked for, and among the dates that both have: a batch
        of dates of its own joins nothing. Sums of many lines need no search: the older lines of those dates
        are summed by keys along with the new ones, in the same shuffle, and combinations without any new or gone line dropped.
        """
        ids = [spec.source_id for spec in DIMENSIONS]
        date = DATE.source_id
        path = new_folder(self.spark, "shared-dates")
        try:
            touched = new.unionByName(gone).select(ids)
            buckets = [r[0] for r in touched.select(self.lines.parts[self.bucket][1].alias("bucket")).distinct().collect()]
            older = kept.where(F.col(self.bucket).isin(buckets) if buckets else F.lit(False))
            # As few rows as days, written down as both sides of the join need them.
            older.select(date).intersect(touched.select(date)).write.parquet(path)
            shared = read_parquet(self.spark, path, StructType([SILVER[date]]))
            lines, marks = new, []
            if not shared.isEmpty():
                older = _of_dates(older, shared)
                if on_duplicate == "aggregate" and touched.count() > SEARCHED_LINES:
                    marks = ["is_touched", "is_line"]
                    none = [F.lit(None).cast(SILVER[c].dataType).alias(c) for c in ("Revenue", "Units_Sold", "revenuePerUnit")]
                    lines = _marked(new, True, True).unionByName(_marked(older.select(new.columns), False, True))
                    lines = lines.unionByName(_marked(gone.select(*ids, *none), True, False), allowMissingColumns=True)
                else:
                    lines = new.unionByName(self.lines_of(_of_dates(touched, shared), older))
            rows = build_fact(lines, self.dimensions(), sizes=self._sizes(), kept=marks)
            if on_duplicate == "aggregate":
                rows = to_grain(rows, *marks)
            touched_keys = None
            if not gone.isEmpty():
                touched_keys = star_lookup(gone.select(ids).distinct(), key_lookups(self.dimensions()), sizes=self._sizes()).select(FACT_KEYS)
            self.merge_fact(rows, on_duplicate != "raise", touched_keys)
        finally:
            drop_folder(self.spark, path)

    def reload(self, bronze: DataFrame, on_duplicate: str = "raise") -> None:
        """Rebuild silver and the fact from all of bronze; members keep their keys. Silver changes last."""
        with self._incoming(bronze, None) as silver:
            self.refresh_dimensions(silver)
            self.load_fact(silver, on_duplicate, rebuild=True)
            self.lines.put()
        self.register()

    # -- catalog --------------------------------------------------------------

    def create_schemas(self) -> None:
        """The schemas have no location, so that dropping one cannot take the data with it."""
        for name in (self.silver_schema, self.gold_schema):
            self.spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name}")

    def register(self) -> None:
        """Publish the current tables in the catalog; also what a new session calls first. What is not there yet is left out."""
        self.create_schemas()
        if self.lines.exists():
            columns = ", ".join(SILVER.fieldNames())
            self.spark.sql(f"CREATE OR REPLACE VIEW {self.silver_schema}.sales AS SELECT {columns} FROM {self.lines.name}")
        for table in (*self.dims.values(), self.fact, *self.totals.values()):
            table.exists()


def _marked(lines: DataFrame, is_touched: bool, is_line: bool) -> DataFrame:
    """``lines`` with whether their combinations are to be computed anew, and whether they count in the sums."""
    return lines.withColumns({"is_touched": F.lit(is_touched), "is_line": F.lit(is_line)})


def _of_dates(lines: DataFrame, dates: DataFrame) -> DataFrame:
    """The ``lines`` whose date id is one of ``dates``; the planner broadcasts these."""
    return lines.alias("line").join(dates.alias("dates"), same(f"line.{DATE.source_id}", f"dates.{DATE.source_id}"), "left_semi")
