"""Left lookups that stay whole and balanced at any size.

A lookup side is broadcast only after its size was measured. A larger side is joined
by an exchange in which the heaviest keys are divided: their flow rows go to several
parts, their lookup row (one per key) is copied to each part.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from netledger.session import ensure_checkpoint_dir

ROW_OVERHEAD = 64


@dataclass(frozen=True)
class JoinPolicy:
    """``broadcast_bytes`` is shared by all sides of a plan, which an executor holds at the same time."""

    broadcast_bytes: int = 128 << 20
    rows_per_part: int = 1_000_000
    heavy_keys: int = 100_000


def _row_bytes(df: DataFrame) -> Column:
    """Upper bound for a row's size in a hash table, which holds the key a second time."""
    total = F.lit(ROW_OVERHEAD + 16 * len(df.columns))
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            total = total + F.coalesce(F.octet_length(F.col(f"`{f.name}`")), F.lit(0))
        elif not isinstance(f.dataType, (T.NumericType, T.BooleanType, T.DateType, T.TimestampType)):
            total = total + F.coalesce(F.octet_length(F.to_json(F.struct(F.col(f"`{f.name}`")))), F.lit(0))
    return (total * 2).cast("long")


def measure(frames: dict[str, DataFrame]) -> dict[str, int]:
    """Bytes of each frame, counted in one job that returns one row per frame."""
    job = None
    for name, df in frames.items():
        rows = df.select(F.lit(name).alias("name"), _row_bytes(df).alias("bytes"))
        job = rows if job is None else job.unionAll(rows)
    sizes = dict.fromkeys(frames, 0)
    if job is not None:
        totals = job.groupBy("name").agg(F.sum("bytes").alias("bytes")).collect()
        sizes.update({r["name"]: int(r["bytes"]) for r in totals})
    return sizes


def fits_broadcast(frames: dict[str, DataFrame], policy: JoinPolicy) -> set[str]:
    """Names of the frames that fit into one budget of memory together; the largest are left out first."""
    if policy.broadcast_bytes <= 0:
        return set()
    return within_budget(measure(frames), policy.broadcast_bytes)


def within_budget(sizes: dict[str, int], budget: int) -> set[str]:
    """The smallest of the sizes whose sum is within the budget."""
    small, held = set(), 0
    for name, size in sorted(sizes.items(), key=lambda x: (x[1], x[0])):
        held += size
        if held > budget:
            break
        small.add(name)
    return small


def _heaviest(counts: DataFrame, keys: list[str], policy: JoinPolicy) -> DataFrame:
    """Keys with more than a part's rows and their number of parts, counted once.

    A part holds ``rows_per_part`` rows, or a ``heavy_keys``-th of all rows of such keys where that is more: no more keys
    than ``heavy_keys`` can have so many, so the list that is broadcast is bounded and no key is left out by number.
    """
    ensure_checkpoint_dir(counts.sparkSession)
    heavy = counts.filter(F.col("_rows") > policy.rows_per_part).checkpoint()
    rows = heavy.agg(F.sum("_rows")).first()[0] or 0
    part = max(policy.rows_per_part, -(-rows // policy.heavy_keys))
    return heavy.filter(F.col("_rows") > part).select(*keys, F.ceil(F.col("_rows") / part).cast("long").alias("_parts"))


def heavy_values(weigh: DataFrame, columns: list[str], policy: JoinPolicy) -> dict[str, DataFrame]:
    """The heavy values of several text key columns, from one scan of ``weigh``."""
    cells = F.array(*[F.struct(F.lit(c).alias("_column"), F.col(c).alias("_value")) for c in columns])
    counts = (weigh.select(F.explode(cells).alias("cell")).select("cell.*")
              .filter(F.col("_value").isNotNull()).groupBy("_column", "_value")
              .agg(F.count(F.lit(1)).alias("_rows")))
    heavy = _heaviest(counts, ["_column", "_value"], policy)
    return {c: heavy.filter(F.col("_column") == c).select(F.col("_value").alias(c), "_parts") for c in columns}


@dataclass
class Spread:
    """Division of the heaviest values of ``keys`` into parts.

    ``weigh`` holds the key columns of the flow (before deduplication is fine: the
    counts only decide how many parts a key gets, never the result). ``heavy`` is given
    where the values were counted together with other keys. ``mark`` names columns that tell most rows apart; by
    default all columns do, which keeps them from being pruned.
    """

    weigh: DataFrame
    keys: list[str]
    part: str
    policy: JoinPolicy = field(default_factory=JoinPolicy)
    heavy: DataFrame | None = None
    mark: list[str] | None = None

    def __post_init__(self) -> None:
        if self.heavy is None:
            counts = (self.weigh.select(*self.keys).na.drop("any").groupBy(*self.keys)
                      .agg(F.count(F.lit(1)).alias("_rows")))
            self.heavy = _heaviest(counts, self.keys, self.policy)

    def divide(self, flow: DataFrame) -> DataFrame:
        """Add the part number; rows without a key are scattered as they match nothing."""
        if self.part in flow.columns:
            return flow
        # The task number keeps exact copies apart and is the same in a retried task.
        mark = F.xxhash64(F.spark_partition_id(), *(self.mark or flow.columns))
        keyless = F.lit(False)
        for key in self.keys:
            keyless = keyless | F.col(key).isNull()
        marked = flow.withColumn("_mark", mark)
        joined = marked.join(F.broadcast(self.heavy), self.keys, "left")
        return joined.withColumn(self.part, F.when(
            keyless, F.col("_mark")).otherwise(
            F.coalesce(F.pmod("_mark", "_parts"), F.lit(0)))).drop("_mark", "_parts")

    def copy(self, dim: DataFrame) -> DataFrame:
        """One copy of a heavy key's lookup row per part."""
        parts = F.sequence(F.lit(0).cast("long"), F.coalesce(F.col("_parts"), F.lit(1)) - 1)
        return (dim.join(F.broadcast(self.heavy), self.keys, "left")
                .withColumn(self.part, F.explode(parts)).drop("_parts"))


    def copies(self, dim: DataFrame) -> int:
        """Rows that ``copy`` adds."""
        return dim.join(F.broadcast(self.heavy), self.keys).agg(F.sum(F.col("_parts") - 1)).first()[0] or 0

    def join(self, flow: DataFrame, dim: DataFrame, key: str) -> DataFrame:
        """Left join of a divided flow with a side that has the keys of the division besides its own."""
        on = list(dict.fromkeys([key, *self.keys, self.part]))
        return flow.join(self.copy(dim).hint("merge"), on, "left")


def attach(flow: DataFrame, dim: DataFrame, keys: list[str], broadcast: bool,
           spread: Spread | None = None, how: str = "left") -> DataFrame:
    """Join ``dim`` (at most one row per key) to ``flow`` on equally named columns.

    ``broadcast`` is the outcome of ``fits_broadcast``; without it ``spread`` divides and
    the merge hint keeps an underestimated side from being broadcast after all.
    """
    if broadcast:
        return flow.join(F.broadcast(dim), keys, how)
    divided = spread.divide(flow)
    return divided.join(spread.copy(dim).hint("merge"), keys + [spread.part], how)


def heavy_rows(side: DataFrame, key: str, heavy: DataFrame) -> tuple[DataFrame | None, int]:
    """The listed keys with their row of ``side`` (NULL where it has none), and their bytes; (None, 0) for an empty list.

    One scan of the side that exchanges nothing but the few rows found.
    """
    if heavy.isEmpty():
        return None, 0
    values = F.struct(*[c for c in side.columns if c != key])
    found = side.join(F.broadcast(heavy.select(key)), key, "left_semi").select(key, values.alias("_found"))
    rows = heavy.select(key, F.lit(True).alias("_heavy")).join(found, key, "left")
    ensure_checkpoint_dir(side.sparkSession)
    rows = rows.checkpoint()
    return rows, measure({"rows": rows})["rows"]


def attach_stored(flow: DataFrame, side: DataFrame, key: str, heavy: DataFrame | None, mark: list[str]) -> DataFrame:
    """Left join of a side that is stored in buckets of its key and is not exchanged.

    Flow rows of ``heavy`` keys take their values from the broadcast ``heavy_rows``. They and rows without a key are dealt to the buckets by
    ``mark``, under a key whose values are not taken should the side hold it. The division stays for the next side with the same key.
    """
    away, bucket = f"_away{key}", f"_bucket{key}"
    values = [c for c in side.columns if c != key]
    if heavy is not None:
        flow = flow.join(F.broadcast(heavy), key, "left")
    if bucket not in flow.columns:
        listed = F.lit(False) if heavy is None else F.coalesce("_heavy", F.lit(False))
        scattered = F.concat(F.lit("\0"), F.xxhash64(F.spark_partition_id(), *mark).cast("string"))
        flow = (flow.withColumns({away: F.col(key).isNull() | listed, "_mark": scattered})
                .withColumn(bucket, F.when(F.col(away), F.col("_mark")).otherwise(F.col(key))).drop("_mark"))
    renamed = side.select(F.col(key).alias(bucket), *[F.col(c).alias(f"_side_{c}") for c in values])
    joined = flow.join(renamed.hint("merge"), bucket, "left")
    taken = {c: F.when(~F.col(away), F.col(f"_side_{c}")) for c in values}
    if heavy is not None:
        taken = {c: F.when(F.col(away), F.col(f"_found.{c}")).otherwise(F.col(f"_side_{c}")) for c in values}
    return joined.withColumns(taken).drop("_heavy", "_found", *[f"_side_{c}" for c in values])


def heavy_sides(side: DataFrame, home: str, heavy: DataFrame) -> tuple[DataFrame | None, int]:
    """All rows of ``side`` that belong to the listed homes, and their bytes; (None, 0) for an empty list."""
    if heavy.isEmpty():
        return None, 0
    ensure_checkpoint_dir(side.sparkSession)
    rows = side.join(F.broadcast(heavy.select(home)), home, "left_semi").checkpoint()
    return rows, measure({"rows": rows})["rows"]


def deal_to_buckets(flow: DataFrame, home: str, heavy: DataFrame, buckets: int, mark: list[str]) -> DataFrame:
    """Exchange a flow to the buckets of sides that are stored by ``home``; rows of heavy homes go to any bucket, by ``mark``."""
    away, bucket = f"_away{home}", f"_bucket{home}"
    scattered = F.concat(F.lit("\0"), F.xxhash64(F.spark_partition_id(), *mark).cast("string"))
    listed = flow.join(F.broadcast(heavy.select(home, F.lit(True).alias("_heavy"))), home, "left")
    dealt = listed.withColumn(away, F.coalesce("_heavy", F.lit(False))).withColumn(bucket, F.when(F.col(away), scattered).otherwise(F.col(home)))
    return dealt.drop("_heavy").repartition(buckets, bucket)


def attach_in_buckets(flow: DataFrame, side: DataFrame, key: str, home: str, heavy: DataFrame | None) -> DataFrame:
    """Left join, in its buckets, of a side stored by ``home`` with at most one row per home and key; heavy homes' rows are broadcast."""
    away, bucket = f"_away{home}", f"_bucket{home}"
    values = [c for c in side.columns if c not in (key, home)]
    renamed = side.select(F.col(home).alias(bucket), key, *[F.col(c).alias(f"_side_{c}") for c in values])
    joined = flow.join(renamed.hint("merge"), [bucket, key], "left")
    taken = {c: F.when(~F.col(away), F.col(f"_side_{c}")) for c in values}
    if heavy is not None:
        joined = joined.join(F.broadcast(heavy.select(home, key, F.struct(*values).alias("_found"))), [home, key], "left")
        taken = {c: F.when(F.col(away), F.col(f"_found.{c}")).otherwise(F.col(f"_side_{c}")) for c in values}
    return joined.withColumns(taken).drop("_found", *[f"_side_{c}" for c in values])


def lookup(flow: DataFrame, dim: DataFrame, keys: list[str], policy: JoinPolicy = JoinPolicy(),
           how: str = "left", bound: DataFrame | None = None) -> DataFrame:
    """``attach`` after measuring; ``how`` may also be left_semi or left_anti.

    ``bound`` is what ``dim`` was reduced from: never smaller, and cheaper to measure.
    """
    if fits_broadcast({"dim": dim if bound is None else bound}, policy):
        return attach(flow, dim, keys, True, how=how)
    spread = Spread(flow, keys, "_part", policy)
    return attach(flow, dim, keys, False, spread, how).drop("_part")
