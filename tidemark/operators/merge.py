"""Idempotent loads: insert-ignore, upsert and write-once.

The pure operators take and return DataFrames. The ``*_into`` sinks apply them to a Parquet
table: they read and rewrite only the partitions that occur in the batch, so the cost of a load
follows the batch and not the table.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import ExitStack, contextmanager, nullcontext
from dataclasses import dataclass
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession, functions as F, types as T

from tidemark.operators.layout import Month, conform, derived_folders, folder_names, folder_sources, with_folders
from tidemark.session import staged


#: Errors of Spark and of the file system, which count as a sink's failure; others are faults of the program.
SINK_ERRORS = (PySparkException, Py4JJavaError, OSError)

# Rows of a batch whose keys are sent to every task, so that a large target's keys are not shuffled.
FEW = 100_000


def first_per_key(
    batch: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column], last: bool = False
) -> DataFrame:
    """The first (or last) row of each key by ``order_by``, and then by all other columns.

    The order is total but for maps, so the same row wins in any order of the input.
    An aggregate with partial combine, not a window: copies of a hot key shrink to one row in
    every map task before the shuffle.
    """
    rest = [name for name in batch.columns if name not in keys]
    if not rest:
        return batch.dropDuplicates(list(keys))
    ties = [f.name for f in batch.schema.fields if f.name in rest and not isinstance(f.dataType, T.MapType)]
    order = F.struct(*[F.col(o) if isinstance(o, str) else o for o in order_by], *[F.col(name) for name in ties])
    pick = F.max_by if last else F.min_by
    chosen = batch.groupBy(key_hash(keys), *keys).agg(pick(F.struct(*rest), order).alias("_row"))
    return chosen.select(*keys, *[F.col("_row").getField(name).alias(name) for name in rest]).select(
        *batch.columns
    )


def key_hash(keys: Sequence[str]) -> Column:
    """A hash of the key; in front of the key it lets a sort tell most keys apart by one number."""
    return F.xxhash64(*keys).alias("_key_hash")


def _same_key(left: str, right: str, keys: Sequence[str], nullable: Sequence[str]) -> Column:
    condition = F.lit(True)
    for key in keys:
        l, r = F.col(f"{left}.{key}"), F.col(f"{right}.{key}")
        condition = condition & (l.eqNullSafe(r) if key in nullable else l == r)
    return condition


def not_in(batch: DataFrame, target: DataFrame, keys: Sequence[str], nullable: Sequence[str] = ()) -> DataFrame:
    """Rows of ``batch`` whose key is not in ``target``; keys in ``nullable`` match null with null."""
    return batch.alias("b").join(
        target.select(*keys).alias("t"), _same_key("b", "t", keys, nullable), "left_anti"
    )


def narrowed(target: DataFrame, batch: DataFrame, keys: Sequence[str], nullable: Sequence[str] = ()) -> DataFrame:
    """Keys of ``target`` that occur in ``batch``.

    With a small batch Spark broadcasts the batch's keys, so a large target is not shuffled.
    """
    return target.select(*keys).alias("t").join(
        batch.select(*keys).alias("b"), _same_key("t", "b", keys, nullable), "left_semi"
    )


def insert_ignore(
    target: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str | Column],
    nullable: Sequence[str] = (),
) -> DataFrame:
    """Rows to append: the first of each key in ``batch`` that ``target`` does not have.

    Known keys go first, so that a repeated load has next to nothing left to sort.
    """
    return first_per_key(not_in(batch, target, keys, nullable), keys, order_by)


def upsert(
    target: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    update_columns: Sequence[str],
    order_by: Sequence[str | Column],
) -> DataFrame:
    """New content of ``target``: matched keys get the batch's ``update_columns``, new keys are added.

    Columns outside ``update_columns`` keep the value of the first insert. If a key comes more
    than once in ``batch``, the last row by ``order_by`` counts.
    """
    new = first_per_key(batch, keys, order_by, last=True).withColumn("_in_batch", F.lit(True))
    old = target.withColumn("_in_target", F.lit(True))
    joined = old.alias("t").join(new.alias("b"), _same_key("t", "b", keys, ()), "full")

    def value(name: str) -> Column:
        before, after = F.col(f"t.{name}"), F.col(f"b.{name}")
        if name in keys:
            return F.coalesce(before, after)
        if name in update_columns:
            return F.when(F.col("_in_batch"), after).otherwise(before)
        return F.when(F.col("_in_target"), before).otherwise(after)

    return joined.select(*[value(name).alias(name) for name in target.columns])


def load_report(
    target: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    by: Sequence[str],
    nullable: Sequence[str] = (),
) -> DataFrame:
    """Rows in, inserted and skipped of an insert-ignore, per value of ``by``.

    ``by`` must be part of the key, so that all copies of a key count in one group.
    """
    copies = batch.groupBy(*keys).agg(F.count("*").alias("_copies"))
    known = target.select(*keys).distinct().withColumn("_known", F.lit(True))
    marked = copies.alias("b").join(known.alias("t"), _same_key("b", "t", keys, nullable), "left")
    return marked.groupBy(*[F.col(f"b.{name}") for name in by]).agg(
        F.sum("_copies").alias("rows_in"),
        F.count_if(F.col("_known").isNull()).alias("inserted"),
        (F.sum("_copies") - F.count_if(F.col("_known").isNull())).alias("skipped"),
    )


# ---------------------------------------------------------------- Parquet tables


@dataclass(frozen=True)
class LoadResult:
    rows_in: int
    inserted: int

    @property
    def skipped(self) -> int:
        return self.rows_in - self.inserted


def read_table(
    spark: SparkSession, path: str, schema: T.StructType, partition_by: Sequence[str | Month] = ()
) -> DataFrame:
    """A Parquet table, or an empty frame when nothing has been written yet.

    With ``partition_by`` the folder columns that follow from others are there too, for pruning.
    """
    schema = _with_derived(schema, partition_by)
    found = _read_written(spark, path, schema)
    return spark.createDataFrame([], schema) if found is None else found


def _with_derived(schema: T.StructType, partition_by: Sequence[str | Month]) -> T.StructType:
    return T.StructType(schema.fields + [T.StructField(name, T.DateType()) for name in derived_folders(partition_by)])


def _read_written(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame | None:
    """A Parquet table, or nothing when it has not been written yet."""
    try:
        return spark.read.schema(schema).parquet(path).select(*schema.names)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def touched(
    target: DataFrame, batch: DataFrame, partition_by: Sequence[str | Month], keys: Sequence[str] = ()
) -> DataFrame:
    """``target`` limited to the folders that occur in ``batch``, null ones among them.

    The bounds of each folder column, two values for the driver, prune the scan. A semi join on whole
    tuples of folder values then keeps out what lies between them, combinations the batch does
    not have too; there is no limit to the number of folders. Rows outside the bounds of ``keys``
    are left out as well: files are sorted by them, so their statistics skip most of a folder.
    """
    names = folder_names(partition_by)
    if not names:
        return target
    batch = with_folders(batch, partition_by)
    bounded = [*names, *[key for key in keys if key not in names]]
    return _within(target, batch.agg(*_extremes(bounded)).first(), batch.select(*names).distinct(), bounded)


def _extremes(bounded: Sequence[str]) -> list[Column]:
    """Bounds and number of nulls of columns."""
    return [
        *[f(name).alias(f"{kind}_{i}") for i, name in enumerate(bounded) for kind, f in (("min", F.min), ("max", F.max))],
        *[F.count_if(F.col(name).isNull()).alias(f"nulls_{i}") for i, name in enumerate(bounded)],
    ]


def _within(target: DataFrame, found: Row, folders: DataFrame, bounded: Sequence[str]) -> DataFrame:
    """``target`` within the bounds ``found`` of its columns ``bounded``, and in ``folders``."""
    for i, name in enumerate(bounded):
        within = F.col(name).between(F.lit(found[f"min_{i}"]), F.lit(found[f"max_{i}"]))
        target = target.where(within | F.col(name).isNull() if found[f"nulls_{i}"] else within)
    return narrowed_rows(target, folders, folders.columns)


@contextmanager
def _footprint(
    batch: DataFrame, partition_by: Sequence[str | Month], keys: Sequence[str]
) -> Iterator[tuple[int, Callable[[DataFrame], DataFrame]]]:
    """The number of rows of ``batch``, and what limits a target as ``touched`` does, in one pass over the batch.

    A row per folder is written to the work folder. Keys that are texts are not bounded: their bounds
    would have to be found by a sort.
    """
    names = folder_names(partition_by)
    if not names:
        yield batch.count(), lambda target: target
        return
    plain = [k for k in keys if k not in names and not isinstance(batch.schema[k].dataType, T.StringType)]
    rows = with_folders(batch, partition_by).groupBy(*names).agg(F.count(F.lit(1)).alias("_rows"), *_extremes(plain))
    with staged(rows, "folders") as folders:
        total = folders.agg(
            F.coalesce(F.sum("_rows"), F.lit(0)).alias("rows"),
            *[f(f"{kind}_{i}").alias(f"{kind}_{i}") for i in range(len(plain)) for kind, f in (("min", F.min), ("max", F.max))],
            *[F.sum(f"nulls_{i}").alias(f"nulls_{i}") for i in range(len(plain))],
        ).first()
        bounds = folders.agg(*_extremes(names)).first()
        mine = folders.select(*names)
        yield total["rows"], lambda target: _within(_within(target, bounds, mine, names), total, mine, plain)


def narrowed_rows(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``target`` whose ``keys`` occur in ``batch``; nulls match nulls."""
    return target.alias("t").join(batch.alias("b"), _same_key("t", "b", keys, keys), "left_semi")


def _gathered(df: DataFrame, partition_by: Sequence[str | Month]) -> DataFrame:
    """``df`` with its folder columns, each folder's rows gathered by one shuffle.

    Adaptive execution splits large folders over several tasks.
    """
    names = folder_names(partition_by)
    return with_folders(df, partition_by).hint("rebalance", *[F.col(name) for name in names]) if names else df


def _sorted(rows: DataFrame, partition_by: Sequence[str | Month], keys: Sequence[str]) -> DataFrame:
    """Rows of month folders in the order of their files: by date and key."""
    if not derived_folders(partition_by):
        return rows
    names, sources = folder_names(partition_by), folder_sources(partition_by)
    order = [*names, *[name for name in sources if name not in names], *[key for key in keys if key not in sources]]
    return rows.sortWithinPartitions(*order)


def _writer(
    df: DataFrame, mode: str, partition_by: Sequence[str | Month], keys: Sequence[str], gathered: bool = False
):
    """A writer of ``df`` into folders, one shuffle that gathers each folder's rows unless they are ``gathered``.

    Files of month folders are sorted by date and key, and
    Parquet adds Bloom filters on the key's texts where they are too many for a dictionary, so a reader of
    a few days or places skips most row groups.
    """
    names = folder_names(partition_by)
    if not names:
        return df.write.mode(mode)
    rows = with_folders(df, partition_by) if gathered else _gathered(df, partition_by)
    writer = _sorted(rows, partition_by, keys).write.mode(mode)
    if not derived_folders(partition_by):
        return writer.partitionBy(*names)
    writer = writer.option("parquet.bloom.filter.adaptive.enabled", "true")
    for key in keys:
        if isinstance(df.schema[key].dataType, T.StringType):
            writer = writer.option(f"parquet.bloom.filter.enabled#{key}", "true")
    return writer.partitionBy(*names)


def append(
    df: DataFrame, path: str, partition_by: Sequence[str | Month] = (), keys: Sequence[str] = (), gathered: bool = False
) -> None:
    """Plain append; ``keys`` only order the rows of a file. ``gathered`` rows of a folder are not shuffled again."""
    _writer(df, "append", partition_by, keys, gathered).parquet(path)


def replace_partitions(
    df: DataFrame, path: str, partition_by: Sequence[str | Month], keys: Sequence[str] = ()
) -> None:
    """Overwrite only the folders that occur in ``df``."""
    _writer(df, "overwrite", partition_by, keys).option("partitionOverwriteMode", "dynamic").parquet(path)


def _counted_append(
    new: DataFrame, path: str, partition_by: Sequence[str | Month], keys: Sequence[str] = ()
) -> int:
    """Append and return the number of rows, counted while they are written."""
    seen = Observation()
    append(new.observe(seen, F.count(F.lit(1)).alias("rows")), path, partition_by, keys)
    return seen.get["rows"]


def insert_ignore_into(
    batch: DataFrame,
    path: str,
    schema: T.StructType,
    keys: Sequence[str],
    order_by: Sequence[str | Column],
    partition_by: Sequence[str | Month] = (),
    nullable: Sequence[str] = (),
    stored: bool = False,
) -> LoadResult:
    """Append the rows whose key is new to the table at ``path``.

    ``partition_by`` must follow from the key: an equal key then lies in an equal folder. The
    batch is written to the work folder for the time of the load, unless the caller has done so
    (``stored``); new rows are computed once, on their way into the table.
    """
    if not set(folder_sources(partition_by)) <= set(keys):
        raise ValueError("Partition columns must be part of the key")
    batch = conform(batch, schema)
    with nullcontext(batch) if stored else staged(batch, "batch") as batch:
        target = touched(read_table(batch.sparkSession, path, schema, partition_by), batch, partition_by, keys)
        known = narrowed(target, batch, keys, nullable)
        new = insert_ignore(known, batch, keys, order_by, nullable)
        return LoadResult(batch.count(), _counted_append(new, path, partition_by, keys))


def insert_ignore_copies(
    batch: DataFrame,
    paths: Sequence[str],
    schema: T.StructType,
    keys: Sequence[str],
    order_by: Sequence[str | Column],
    partition_by: Sequence[str | Month] = (),
    nullable: Sequence[str] = (),
) -> list[LoadResult | Exception]:
    """``insert_ignore_into`` for several copies of one table, with one pass over the batch.

    The keys that the copies know carry a bit per copy, so one aggregate of keys finds those that any copy lacks;
    only their rows are read whole, and the first row of a key is picked once. Nothing is compared while no copy has
    been written. New rows are gathered and sorted once, on their way to the work folder, and each copy then takes
    what it lacks. A copy that can't be read or written gives its error instead of a result, and does not stop the others.
    """
    if not set(folder_sources(partition_by)) <= set(keys):
        raise ValueError("Partition columns must be part of the key")
    outcome: dict[int, LoadResult | Exception] = {}
    with staged(conform(batch, schema), "batch") as batch:
        targets: dict[int, DataFrame] = {}
        for i, path in enumerate(paths):
            try:
                target = _read_written(batch.sparkSession, path, _with_derived(schema, partition_by))
                if target is not None:
                    targets[i] = target
            except SINK_ERRORS as error:
                outcome[i] = error
        if len(outcome) == len(paths):
            return [outcome[i] for i in range(len(paths))]
        every = sum(1 << i for i in range(len(paths)) if i not in outcome)
        with ExitStack() as held:
            if targets:
                rows_in, limit = held.enter_context(_footprint(batch, partition_by, keys))
                known = reduce(
                    DataFrame.union,
                    [limit(t).select(*keys, F.lit(1 << i).alias("_copies")) for i, t in targets.items()],
                )
                missing = _missing(batch.select(*keys), known, every, keys, nullable, rows_in <= FEW)
                lacking = _rows_of(batch, held.enter_context(staged(missing, "missing")), keys)
            else:
                rows_in, lacking = batch.count(), batch.withColumn("_copies", F.lit(0))
            new = _gathered(first_per_key(lacking, keys, order_by), partition_by)
            new = held.enter_context(staged(_sorted(new, partition_by, keys), "new"))
            counts = {row["_copies"]: row["count"] for row in new.groupBy("_copies").count().collect()}
            for i, path in enumerate(paths):
                if i in outcome:
                    continue
                own = new.where(F.col("_copies").bitwiseAND(1 << i) == 0).select(*schema.names)
                inserted = sum(n for copies, n in counts.items() if not copies & 1 << i)
                try:
                    if inserted:
                        append(own, path, partition_by, keys, gathered=True)
                    outcome[i] = LoadResult(rows_in, inserted)
                except SINK_ERRORS as error:
                    outcome[i] = error
    return [outcome[i] for i in range(len(paths))]


def _missing(
    mine: DataFrame, known: DataFrame, every: int, keys: Sequence[str], nullable: Sequence[str], few: bool
) -> DataFrame:
    """Keys of a batch that some copy lacks, with the bits of the copies that have them in ``_copies``.

    A key with a null outside ``nullable`` equals no other. ``few``: the batch's keys go to every task, so
    that a large target's keys are not shuffled.
    """
    if few:
        known = known.alias("t").join(F.broadcast(mine).alias("b"), _same_key("t", "b", keys, nullable), "left_semi")
    known = known.dropna(subset=[key for key in keys if key not in nullable])
    own = 1 << every.bit_length()
    marked = mine.withColumn("_copies", F.lit(own)).union(known)
    return (
        marked.groupBy(key_hash(keys), *keys)
        .agg(F.bit_or("_copies").alias("_copies"))
        .where((F.col("_copies") >= own) & (F.col("_copies").bitwiseAND(every) != every))
        .withColumn("_copies", F.col("_copies").bitwiseAND(every))
    )


def _rows_of(batch: DataFrame, missing: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``batch`` whose key is in ``missing``, with its ``_copies``; a repeated load misses none."""
    joined = batch.withColumn("_key_hash", key_hash(keys)).alias("b").join(
        missing.alias("t"), (F.col("b._key_hash") == F.col("t._key_hash")) & _same_key("b", "t", keys, keys)
    )
    return joined.select(*[F.col(f"b.{name}").alias(name) for name in batch.columns], F.col("t._copies").alias("_copies"))


def upsert_into(
    batch: DataFrame,
    path: str,
    schema: T.StructType,
    keys: Sequence[str],
    update_columns: Sequence[str],
    order_by: Sequence[str | Column],
    partition_by: Sequence[str | Month],
    stored: bool = False,
) -> LoadResult:
    """Upsert ``batch`` into the table at ``path``, rewriting only the folders it touches.

    The new content is written to the work folder first, so the table is never read while it
    is replaced. Loads of one table must not run at the same time: the later one would put back
    what it had read.
    """
    if not partition_by or not set(folder_sources(partition_by)) <= set(keys):
        raise ValueError("Partition columns must be part of the key")
    batch = conform(batch, schema)
    with nullcontext(batch) if stored else staged(batch, "batch") as batch:
        rows_in = batch.count()
        if not rows_in:
            return LoadResult(0, 0)
        target = touched(read_table(batch.sparkSession, path, schema, partition_by), batch, partition_by)
        target = target.select(*schema.names)
        with staged(upsert(target, batch, keys, update_columns, order_by), "upsert") as merged:
            replace_partitions(merged, path, partition_by, keys)
        return LoadResult(rows_in, rows_in)


def fingerprints(table: DataFrame, by: Sequence[str]) -> DataFrame:
    """Per value of ``by``: number of rows, and two sums over hashes of whole rows, whatever their order."""
    rest = [F.col(name) for name in table.columns if name not in by]
    code = F.xxhash64(*rest)
    return table.groupBy(*by).agg(
        F.struct(
            F.count("*").alias("n"), F.bit_xor(code).alias("xor"),
            F.sum(F.pmod(code, F.lit(1 << 31))).alias("sum"),
        ).alias("mark")
    )


def differing(left: DataFrame, right: DataFrame, by: Sequence[str]) -> DataFrame:
    """Values of ``by`` whose rows are not the same in both tables; one of them may lack the value."""
    a, b = fingerprints(left, by).alias("a"), fingerprints(right, by).alias("b")
    both = a.join(b, _same_key("a", "b", by, by), "full")
    return both.where(~F.col("a.mark").eqNullSafe(F.col("b.mark"))).select(
        *[F.coalesce(f"a.{name}", f"b.{name}").alias(name) for name in by]
    )


def new_partitions(target: DataFrame, batch: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Rows of ``batch`` that belong to partitions ``target`` does not have."""
    return not_in(batch, target.select(*partition_by).distinct(), partition_by, partition_by)


def write_once(
    batch: DataFrame, path: str, schema: T.StructType, units: Sequence[str],
    partition_by: Sequence[str | Month] | None = None, keys: Sequence[str] = (),
) -> LoadResult:
    """Write units (tuples of values) that the table does not have; rows of units it has are skipped.

    Units may be smaller than the table's folders, which follow from them (none given: they are the folders).
    """
    folders = units if partition_by is None else partition_by
    with staged(conform(batch, schema), "batch") as batch:
        target = touched(read_table(batch.sparkSession, path, schema, folders), batch, folders, units)
        new = new_partitions(target, batch, units)
        return LoadResult(batch.count(), _counted_append(new, path, folders, keys))


def write_report(target: DataFrame, batch: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Per partition of ``batch``: whether a write-once load writes it, and why."""
    mine = batch.select(*partition_by).distinct()
    theirs = target.select(*partition_by).distinct().withColumn("_known", F.lit(True))
    known = F.col("_known").isNotNull()
    return mine.join(theirs, list(partition_by), "left").select(
        *partition_by,
        (~known).alias("uploaded"),
        F.when(known, "already_exists").otherwise("created").alias("reason"),
    )
