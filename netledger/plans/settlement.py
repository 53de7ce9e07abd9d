"""Settlement of the two payment flows.

One logical plan: last arrival per key, trade filter, left lookups, merchant
resolution, fee, signed net amount. With lookup tables of broadcast size the flow is
shuffled once for deduplication and once, already summed per task, for the totals.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from netledger.functions import money
from netledger.functions.text import key_of, slice_text
from netledger.operators import filters, lookups
from netledger.operators.dedup import latest
from netledger.operators.joins import (JoinPolicy, Spread, attach, attach_in_buckets, attach_stored, deal_to_buckets, fits_broadcast,
                                       heavy_rows, heavy_sides, heavy_values, within_budget)
from netledger.operators.totals import merchant_totals


@dataclass(frozen=True)
class Dimensions:
    codes: DataFrame
    groups: DataFrame
    mappings: DataFrame
    fees: DataFrame
    version: str = ""
    #: Sides that a load has stored (``plans.sides``): name -> the bucketed table and its bytes.
    stored: dict[str, tuple[DataFrame, int]] | None = None
    #: Those of them whose keys begin with the merchant, in buckets of the merchant (``HOME``), and their number of buckets.
    homes: dict[str, DataFrame] | None = None
    buckets: int = 0

    def files(self) -> frozenset[str]:
        """The files the tables are read from, or the publication of the stored sides; empty when some table has none."""
        if self.stored:
            return frozenset([self.version])
        names = [df.inputFiles() for df in (self.codes, self.groups, self.mappings, self.fees)]
        return frozenset(f for part in names for f in part) if all(names) else frozenset()


def _normal_store() -> Column:
    return F.when(F.col("in_store_group") & (F.length("rsv4") >= 24), slice_text("rsv4", 20, 24))


def _normal_store_any_group() -> Column:
    return F.when(F.length("rsv4") >= 24, slice_text("rsv4", 20, 24))


def _incre_store() -> Column:
    return F.when(F.col("rsvd1").startswith("SML"), F.trim(slice_text("rsvd1", 7, 50)))


@dataclass(frozen=True)
class Job:
    """What differs between the two flows."""

    name: str
    row_key: str
    dedup_keys: list[str]
    merchant: str
    terminal: str
    trade: Callable[[], Column]
    txn_key: Callable[[], Column]
    amount: Callable[[], Column]
    store: Callable[[], Column]
    store_upper: Callable[[], Column]
    store_item: Callable[[Column], Column]
    store_type: str
    settle_when: bool
    #: Whether a store's key begins with the merchant, as a terminal's does.
    store_of_merchant: bool
    rate_divisor: int = 100
    unbounded_negative_cap: bool = False


NORMAL = Job(
    name="normal", row_key="id", dedup_keys=["id"], merchant="mid", terminal="tid",
    trade=filters.normal_trade,
    txn_key=lambda: key_of("msg_type", "proc_code", "ser_concode", sep="|"),
    amount=lambda: F.col("txn_amt"),
    store=_normal_store, store_upper=_normal_store_any_group,
    store_item=lambda store: F.concat_ws(",", F.col("mid"), store),
    store_type=lookups.NORMAL_STORE_TYPE, settle_when=False, store_of_merchant=True)

INCRE = Job(
    name="incre", row_key="plt_ssn", dedup_keys=["plt_ssn", "mchnt_id_pay", "term_id_pay"],
    merchant="mchnt_id_pay", terminal="term_id_pay",
    trade=filters.incre_trade,
    txn_key=lambda: F.col("trans_cd_pay"),
    amount=lambda: money.to_yuan(F.col("trans_amt")),
    store=_incre_store, store_upper=_incre_store,
    store_item=lambda store: store,
    store_type=lookups.INCRE_STORE_TYPE, settle_when=True, store_of_merchant=False)


# The five lookup sides of a settlement and their keys.
SIDE_KEYS = {"codes": "txn_key", "groups": "_merchant", "fees": "_merchant",
             "terminals": "_terminal_item", "stores": "_store_item"}
SIDES = tuple(SIDE_KEYS)


def of_merchant(job: Job) -> list[str]:
    """The sides whose keys are or begin with the merchant."""
    return ["groups", "fees", "terminals", *(["stores"] if job.store_of_merchant else [])]


def stored_name(name: str, job: Job) -> str:
    """The name under which a side is stored; the flows differ in their stores only."""
    return f"stores_{job.name}" if name == "stores" else name


def reduced(dims: Dimensions, job: Job, name: str) -> DataFrame:
    """A side from its dimension: at most one row per key."""
    if name == "codes":
        return lookups.codes(dims.codes)
    if name == "groups":
        return lookups.group_lists(dims.groups).withColumnRenamed("item", "_merchant")
    if name == "terminals":
        return lookups.first_mapping(dims.mappings, lookups.TERMINAL_TYPE, "_terminal_item", "_terminal_result")
    if name == "stores":
        return lookups.first_mapping(dims.mappings, job.store_type, "_store_item", "_store_result")
    return lookups.best_profile(dims.fees).select(
        F.col("mer_no").alias("_merchant"), F.lit(True).alias("_has_profile"), "credit_calc_type",
        "credit_calc_rate", "credit_calc_amt", "credit_min_amt", "credit_max_amt")


class Lookups:
    """The dimensions reduced to one row per key, with the measured way to join each.

    A reduced side is never larger than its input (a joined group list holds the same
    characters plus separators, covered by the row overhead), so measuring the input
    bounds what is broadcast and needs no shuffle. Stored sides are reduced and measured already.

    ``together`` lets the large sides of the merchant share one exchange of the flow, in jobs run with ``session.large_writes``.
    """

    def __init__(self, dims: Dimensions, job: Job, policy: JoinPolicy = JoinPolicy(),
                 names: tuple[str, ...] = SIDES, together: bool = False):
        self.dims, self.job, self.policy, self.names, self.together = dims, job, policy, names, together
        self._kept: dict[str, DataFrame] = {}
        #: What the sides of broadcast size leave of the budget, known for stored sides only.
        self.budget = 0
        if dims.stored:
            sizes = {name: dims.stored[stored_name(name, job)][1] for name in names}
            self.small = within_budget(sizes, policy.broadcast_bytes) if policy.broadcast_bytes > 0 else set()
            self.budget = policy.broadcast_bytes - sum(sizes[name] for name in self.small)
            return
        mappings = dims.mappings.select("type_id", "src_item", "map_result")
        inputs = {
            "codes": dims.codes.select("txn_key", "sett_flg", "dc_flg"),
            "groups": dims.groups.select("item", "group_id"),
            "terminals": mappings.filter(F.col("type_id") == lookups.TERMINAL_TYPE),
            "stores": mappings.filter(F.col("type_id") == job.store_type),
            "fees": dims.fees,
        }
        self.small = fits_broadcast({name: inputs[name] for name in names}, policy)

    def keep(self) -> Lookups:
        """Cache the sides of broadcast size, for use by many batches."""
        self._kept = {name: self.side(name).persist() for name in self.small}
        return self

    def release(self) -> None:
        for side in self._kept.values():
            side.unpersist()
        self._kept = {}

    def side(self, name: str) -> DataFrame:
        """The reduced dimension: at most one row per key."""
        if name in self._kept:
            return self._kept[name]
        if self.dims.stored:
            return self.dims.stored[stored_name(name, self.job)][0]
        return reduced(self.dims, self.job, name)

    def home_side(self, name: str) -> DataFrame:
        """A stored side in buckets of ``HOME``."""
        stored = stored_name(name, self.job)
        if stored in self.dims.homes:
            return self.dims.homes[stored]
        side = self.dims.stored[stored][0]
        return side.select(F.col(SIDE_KEYS[name]).alias(HOME), *side.columns)


class Attacher:
    """Joins lookup sides to a flow; sides with an equal key share one division of it.

    A stored side is joined bucket by bucket without an exchange of its own while the rows of its heavy keys fit into what is left
    of the broadcast budget, else divided like any other.

    ``weigh`` is the flow before deduplication: it tells which keys are heavy. A stream's keys cannot be counted before; for it
    ``heavy`` names a list of them that was counted earlier (see ``heavy_list``), or is empty. Rows without a key are scattered in any case.
    """

    def __init__(self, tables: Lookups, weigh: DataFrame, heavy: dict[str, DataFrame] | None = None):
        self.tables, self.weigh = tables, weigh
        self.budget = tables.budget
        self.spreads: dict[str, Spread] = {}
        #: Sides by the merchant (``gather``), and the division of the flow that they share.
        self.gathered: dict[str, DataFrame] = {}
        self.home: Spread | None = None
        #: Stored sides by the merchant -> their rows of heavy merchants.
        self.stored: dict[str, DataFrame | None] = {}
        if heavy is not None:
            for key in dict.fromkeys(SIDE_KEYS.values()):
                listed = heavy.get(key)
                if listed is None:
                    listed = weigh.sparkSession.createDataFrame([], f"{key} string, _parts long")
                self.spreads[key] = Spread(weigh, [key], f"_part{key}", tables.policy, listed, tables.job.dedup_keys)

    def __call__(self, flow: DataFrame, name: str) -> DataFrame:
        key, side = SIDE_KEYS[name], self.tables.side(name)
        if name in self.tables.small:
            return attach(flow, side, [key], True)
        if name in self.gathered:
            return self.home.join(flow, self.gathered[name], key)
        if name in self.stored:
            return attach_in_buckets(flow, self.tables.home_side(name), key, HOME, self.stored[name])
        spread = self._spread(key)
        if self.tables.dims.stored:
            rows, size = heavy_rows(side, key, spread.heavy)
            if size <= self.budget:
                self.budget -= size
                return attach_stored(flow, side, key, rows, self.tables.job.dedup_keys)
        return attach(flow, side, [key], False, spread)

    def gather(self, flow: DataFrame) -> DataFrame:
        """Exchange the flow once for all large sides of the merchant, before their keys are made, so it is narrow.

        Such a side is dealt by the merchant as well and joined by its own key. Heavy merchants are divided; a side that would need
        more than ``rows_per_part`` copies for that keeps the exchange by its own key.
        """
        job, policy = self.tables.job, self.tables.policy
        large = [n for n in of_merchant(job) if n in self.tables.names and n not in self.tables.small]
        if not self.tables.together or len({SIDE_KEYS[n] for n in large}) < 2 or (self.tables.dims.stored and not self.tables.dims.homes):
            return flow
        merchant = F.coalesce(F.col(job.merchant), F.lit(""))
        heavy = heavy_values(self.weigh.select(merchant.alias(HOME)), [HOME], policy)[HOME]
        if self.tables.dims.stored:
            rows = {n: heavy_sides(self.tables.home_side(n), HOME, heavy) for n in large}
            size = sum(size for _, size in rows.values())
            if size > self.budget:
                return flow
            self.budget -= size
            self.stored = {n: found for n, (found, _) in rows.items()}
            return deal_to_buckets(flow.withColumn(HOME, merchant), HOME, heavy, self.tables.dims.buckets, job.dedup_keys)
        self.home = Spread(self.weigh, [HOME], f"_part{HOME}", policy, heavy, job.dedup_keys)
        sides = {n: by_merchant(self.tables.side(n), SIDE_KEYS[n]) for n in large}
        divided = not heavy.isEmpty()
        self.gathered = {n: side for n, side in sides.items() if not divided or self.home.copies(side) <= policy.rows_per_part}
        if len({SIDE_KEYS[n] for n in self.gathered}) < 2:
            self.gathered = {}
            return flow
        # With the number of parts given they are not put together again: rows are sorted for several joins in a task, and are wider then.
        parts = int(flow.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        return self.home.divide(flow.withColumn(HOME, merchant)).repartition(parts, HOME, self.home.part)

    def _spread(self, key: str) -> Spread:
        """All large sides' keys are counted together on the first use."""
        if not self.spreads:
            job, policy = self.tables.job, self.tables.policy
            large = [SIDE_KEYS[n] for n in self.tables.names if n not in self.tables.small and n not in self.gathered and n not in self.stored]
            weigh = lookup_keys(self.weigh, job)
            for column, heavy in heavy_values(weigh, list(dict.fromkeys(large)), policy).items():
                self.spreads[column] = Spread(weigh, [column], f"_part{column}", policy, heavy, job.dedup_keys)
        return self.spreads[key]


#: The merchant as rows are dealt by it: empty text where there is none, as in the keys that begin with it.
HOME = "_home"


def by_merchant(side: DataFrame, key: str) -> DataFrame:
    """A side with the merchant of its key as ``HOME``.

    A longer key holds the merchant before one of its commas, as merchants may hold commas themselves; its row is there once for each.
    """
    if key == SIDE_KEYS["groups"]:
        return side.withColumn(HOME, F.coalesce(F.col(key), F.lit("")))
    commas = F.size(F.split(F.col(key), ",")) - 1
    before = F.transform(F.sequence(F.lit(1), F.greatest(commas, F.lit(1))), lambda i: F.call_function("substring_index", F.col(key), F.lit(","), i))
    return side.filter(F.contains(F.col(key), F.lit(","))).withColumn(HOME, F.explode(before))


def lookup_keys(flow: DataFrame, job: Job) -> DataFrame:
    """The keys that are known before any lookup; a store key may still be withdrawn."""
    store = job.store_upper()
    return flow.withColumns({
        "txn_key": job.txn_key(), "_merchant": F.col(job.merchant),
        "_terminal_item": key_of(job.merchant, job.terminal, sep=","),
        "_store_item": F.when(store.isNotNull(), job.store_item(store))})


def write_heavy_list(flow: DataFrame, job: Job, path: str, policy: JoinPolicy = JoinPolicy()) -> None:
    """Count the lookup keys of past messages and store the heavy ones, for the streams that follow."""
    keys = list(dict.fromkeys(SIDE_KEYS.values()))
    rows = [listed.select(F.lit(key).alias("column"), F.col(key).alias("value"), "_parts")
            for key, listed in heavy_values(lookup_keys(flow, job), keys, policy).items()]
    reduce(DataFrame.unionByName, rows).write.mode("overwrite").parquet(path)


def read_heavy_list(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """Key column -> its heavy values and their numbers of parts."""
    rows = spark.read.parquet(path)
    return {key: rows.filter(F.col("column") == key).select(F.col("value").alias(key), "_parts") for key in dict.fromkeys(SIDE_KEYS.values())}


def trades(flow: DataFrame, job: Job) -> DataFrame:
    """Last arrival per key, then the trade filter."""
    return latest(flow, job.dedup_keys).filter(job.trade())


def with_code(flow: DataFrame, attacher: Attacher) -> DataFrame:
    """filter_flag and dc_flag of the transaction code; a miss leaves false and 0."""
    return attacher(flow, "codes").withColumns({
        "filter_flag": F.coalesce("filter_flag", F.lit(False)),
        "dc_flag": F.coalesce("dc_flag", F.lit(0))})


def with_groups(flow: DataFrame, attacher: Attacher) -> DataFrame:
    """group_id: all groups of the merchant, empty when it has none."""
    return attacher(flow, "groups").withColumns({
        "group_id": F.coalesce("group_id", F.lit("")),
        "in_store_group": F.coalesce("in_store_group", F.lit(False))})


def with_terminal(flow: DataFrame, attacher: Attacher) -> DataFrame:
    return attacher(flow, "terminals").withColumn(
        "map_result_from_terminal", F.coalesce("_terminal_result", F.lit("")))


def with_store(flow: DataFrame, attacher: Attacher) -> DataFrame:
    """store_no and its mapping; the key is NULL where the flow names no store."""
    job = attacher.tables.job
    store = job.store()
    keyed = flow.withColumns({
        "_store_item": F.when(store.isNotNull(), job.store_item(store)),
        "store_no": F.coalesce(store, F.lit(""))})
    return attacher(keyed, "stores").withColumn(
        "map_result_from_rsv", F.coalesce("_store_result", F.lit("")))


def resolve_merchant(job: Job) -> Column:
    """Store mapping, else terminal mapping, else the merchant itself."""
    blank = F.lit("")
    return F.coalesce(F.nullif(F.col("map_result_from_rsv"), blank),
                      F.nullif(F.col("map_result_from_terminal"), blank), F.col(job.merchant))


def with_fee(flow: DataFrame, job: Job) -> DataFrame:
    """Fee, flags and signed net amount of rows that settle.

    Flags stay false outside the eligible rows. ``exchange`` is always 0 in the stored
    detail; the computed amount is in ``fee``.
    """
    found = F.coalesce("_has_profile", F.lit(False))
    raw = money.raw_fee(F.col("_amount"), F.col("credit_calc_type"), F.col("credit_calc_rate"),
                        F.col("credit_calc_amt"), job.rate_divisor)
    fee = money.clamp(F.col("_raw_fee"), F.col("credit_min_amt"), F.col("credit_max_amt"),
                      job.unbounded_negative_cap)
    net = money.signed_net(F.col("_amount"), F.col("_fee"), F.col("dc_flag"))
    flagged = flow.withColumns({
        "_amount": job.amount(),
        "eligible": F.col("filter_flag") == F.lit(job.settle_when)})
    checked = flagged.withColumns({
        "_raw_fee": raw,
        "no_fee_profile": F.col("eligible") & ~found,
        "supported_calc_type": F.col("eligible") & found & money.is_supported(F.col("credit_calc_type"))})
    priced = checked.withColumns({
        "_fee": F.when(F.col("eligible") & found, fee),
        "settled": filters.settles()})
    return priced.withColumns({
        "net": F.when(F.col("settled"), net),
        "fee": F.coalesce("_fee", F.lit(Decimal("0.00"))),
        "exchange": F.lit(0.0)})


def enrich(flow: DataFrame, tables: Lookups, weigh: DataFrame | None = None, heavy: dict[str, DataFrame] | None = None) -> DataFrame:
    """All lookups on an already filtered flow; the row count does not change.

    ``heavy`` is given for a stream (empty without a list): its keys are not counted.
    """
    job = tables.job
    attacher = Attacher(tables, flow if weigh is None else weigh, heavy)
    if heavy is None and "codes" in tables.small:
        flow = attacher.gather(flow)
    coded = with_code(lookup_keys(flow, job), attacher)
    # Groups and fee profiles have the same key, so a divided flow is exchanged once.
    profiled = attacher(with_groups(coded, attacher), "fees")
    mapped = with_store(with_terminal(profiled, attacher), attacher)
    return mapped.withColumn("mer_no", resolve_merchant(job))


def settle_with(flow: DataFrame, tables: Lookups, deduplicate: bool = True) -> DataFrame:
    """``settle`` with lookup sides that were prepared before."""
    job = tables.job
    kept = trades(flow, job) if deduplicate else flow.filter(job.trade())
    done = with_fee(enrich(kept, tables, weigh=flow), job)
    return done.drop(*[c for c in done.columns if c.startswith("_")])


def settle(flow: DataFrame, dims: Dimensions, job: Job, policy: JoinPolicy = JoinPolicy(),
           deduplicate: bool = True, together: bool = False) -> DataFrame:
    """The settled flow: every kept trade with its enrichment, fee and net amount."""
    return settle_with(flow, Lookups(dims, job, policy, together=together), deduplicate)


def summary(settled: DataFrame) -> DataFrame:
    """mer_no -> total."""
    return merchant_totals(settled)


def rejects(settled: DataFrame, job: Job) -> DataFrame:
    """Eligible rows that did not settle, with the reason."""
    return (settled.withColumn("reason", filters.reject_reason())
            .filter(F.col("reason").isNotNull()).select(job.row_key, "reason"))


def detail(settled: DataFrame, layout: dict[str, str], *more: str) -> DataFrame:
    """The stored detail columns, and ``more`` as they are."""
    return settled.select(*[F.col(source).alias(name) for name, source in layout.items()], *more)
