"""A keyed store: rows by key whose cells are put, deleted and read while a stream writes.

Layout below ``path``::

    batches/batch_id=N/_bucket=B   what batch N put or deleted
    bases/NAME/_bucket=B           the merged rows of bucket B up to some batch
    committed/N                    batch N is whole; says which columns it wrote
    published/V                    version V: columns and types, number of buckets, base and last merged batch of each bucket

A put writes the cells of its columns; cells of other columns stay. Reads take, for every column, the cell of the newest batch
that wrote it. A deletion is a batch of its own: it hides all older cells of its keys, and a later put revives a key. Readers
follow the newest version; compaction writes the merged rows of a bucket as a new base and publishes the next version, a step that fails and is
repeated when another writer published first. Batches are committed in the order of their ids by one writer; a batch that is
written again before its commit replaces itself.

Sizes: a batch is exchanged once, to its buckets. A read passes the rows of the bases without an exchange; only keys that batches since
the last compaction touch are merged. A point read opens one bucket, whose files are sorted by key and hold Bloom filters of it.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from netledger.operators.dedup import top_one_of_many
from netledger.operators.joins import JoinPolicy, lookup
from netledger.session import large_writes
from netledger.sinks import publish

_OWN = "_bucket int, _names array<string>, _gone boolean, _tie long"


@dataclass(frozen=True)
class Version:
    """What readers follow: column types, and per bucket its base and the last batch merged into it."""

    number: int
    buckets: int
    columns: dict[str, str]
    bases: dict[int, tuple[str, int]]

    def text(self) -> str:
        return json.dumps({"buckets": self.buckets, "columns": self.columns, "bases": self.bases})

    @classmethod
    def of(cls, number: int, text: str) -> Version:
        held = json.loads(text)
        return cls(number, held["buckets"], held["columns"], {int(b): tuple(v) for b, v in held["bases"].items()})


class KeyedStore:
    """The store at ``path``; the first writer fixes the key's type and the number of buckets."""

    def __init__(self, spark: SparkSession, path: str, key: str, buckets: int = 64, policy: JoinPolicy = JoinPolicy()):
        self.spark, self.path, self.key, self.buckets, self.policy = spark, path.rstrip("/"), key, buckets, policy

    # Versions

    def version(self) -> Version | None:
        found = publish.newest(self.spark, f"{self.path}/published")
        return None if found is None else Version.of(*found)

    def _change(self, change) -> Version:
        """Publish ``change`` of the newest version; repeated on the new one when another writer was first."""
        while True:
            current = self.version() or Version(0, self.buckets, {}, {})
            changed = change(current)
            if changed == current:
                return current
            changed = replace(changed, number=current.number + 1)
            if publish.claim(self.spark, f"{self.path}/published", changed.number, changed.text()):
                return changed

    def _known(self, df: DataFrame, arrival: str | None) -> Version:
        """The version that holds all columns of ``df``."""
        types = {f.name: f.dataType.simpleString() for f in df.schema.fields if f.name != arrival}
        if arrival:
            types["_arrival"] = df.schema[arrival].dataType.simpleString()

        def widen(current: Version) -> Version:
            other = {c: (current.columns[c], t) for c, t in types.items() if current.columns.get(c, t) != t}
            if other:
                raise ValueError(f"columns of another type: {other}")
            return replace(current, columns={**current.columns, **types})

        return self._change(widen)

    def batches(self, version: Version | None = None) -> tuple[int, dict[int, dict]]:
        """(last batch that all buckets have merged, later committed batches with what they wrote)."""
        version = version or self.version()
        merged = [v[1] for v in version.bases.values()] if version and len(version.bases) == version.buckets else []
        upto = min(merged, default=-1)
        return upto, {n: json.loads(publish.get_text(self.spark, f"{self.path}/committed/{n}")) for n in self.committed() if n > upto}

    def committed(self) -> list[int]:
        """The committed batches whose marks were not removed."""
        return sorted(int(n) for n in publish.names(self.spark, f"{self.path}/committed") if n.isdigit())

    # Writes

    def _bucket(self, key: Column, buckets: int) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")

    def write(self, rows: DataFrame, batch_id: int, arrival: str | None = None, gone: bool = False, names: Column | None = None) -> str:
        """Write a batch without committing it; returns its folder. Rows without a key are refused by the caller's schema or dropped."""
        version = self._known(rows, arrival)
        columns = [c for c in rows.columns if c not in (self.key, arrival)]
        listed = F.array(*map(F.lit, columns)) if columns else F.array().cast("array<string>")
        own = {"_names": listed if names is None else names, "_gone": F.lit(gone),
               "_tie": F.xxhash64(*[F.col(f"`{'_arrival' if c == arrival else c}`") for c in rows.columns])}
        out = rows.withColumnRenamed(arrival, "_arrival") if arrival else rows
        target = f"{self.path}/batches/batch_id={batch_id}"
        self._files(self._placed(out, version).repartition("_bucket", "_part"), target, own)
        return target

    def _placed(self, rows: DataFrame, version: Version) -> DataFrame:
        """Rows with their bucket and their part of it, which follow from the key."""
        key = F.col(f"`{self.key}`")
        # Some parts for each task, so that tasks get nearly equal shares of them.
        parts = max(1, 4 * int(self.spark.conf.get("spark.sql.shuffle.partitions")) // version.buckets)
        return rows.withColumns({"_bucket": self._bucket(key, version.buckets),
                                 "_part": F.pmod(F.shiftright(F.xxhash64(key), 32), F.lit(parts)).cast("int")})

    def _files(self, rows: DataFrame, target: str, own: dict[str, Column]) -> None:
        """Files per bucket, one of each task that holds parts of it, sorted by key, with Bloom filters of the keys.

        The columns ``own`` are added last: names of columns repeat in every row, and neither the exchange nor the sort carries them.
        """
        kept = rows.filter(F.col(f"`{self.key}`").isNotNull())
        with large_writes(self.spark):
            (kept.sortWithinPartitions("_bucket", f"`{self.key}`").drop("_part").withColumns(own)
             .write.mode("overwrite").option(f"parquet.bloom.filter.enabled#{self.key}", "true")
             .option("parquet.bloom.filter.adaptive.enabled", "true").partitionBy("_bucket").parquet(target))

    def commit(self, batch_id: int, columns: list[str], gone: bool = False, once: bool = False) -> None:
        """Mark a batch as whole: readers take it from now on. ``once`` says that no key comes twice in it."""
        publish.put_text(self.spark, f"{self.path}/committed/{batch_id}", json.dumps({"columns": columns, "gone": gone, "once": once}))

    def put_rows(self, rows: DataFrame, batch_id: int, arrival: str | None = None, once: bool = False) -> None:
        """Put all columns of ``rows``; NULL is a value. Of a key's rows the last by ``arrival`` wins, then by a hash.

        ``once`` says that no key comes twice, as after a deduplication by it; then a first compaction has nothing to merge.
        """
        self.write(rows, batch_id, arrival)
        self.commit(batch_id, [c for c in rows.columns if c not in (self.key, arrival)], once=once)

    def put_cells(self, cells: DataFrame, batch_id: int, arrival: str | None = None) -> None:
        """Put the columns of ``cells`` as text; NULL becomes empty text. Columns that are not put keep what they hold."""
        texts = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(c) for c in cells.columns if c not in (self.key, arrival)]
        self.put_rows(cells.select(F.col(f"`{self.key}`"), *texts, *([F.col(f"`{arrival}`")] if arrival else [])), batch_id, arrival)

    def put_cell(self, row_key, column: str, value: str | None, batch_id: int) -> None:
        """Put one cell."""
        kind = (self.version() or Version(0, 0, {}, {})).columns.get(self.key, "string")
        self.put_cells(self.spark.range(1).select(F.lit(row_key).cast(kind).alias(self.key), F.lit(value).cast("string").alias(column)), batch_id)

    def delete(self, keys: DataFrame, batch_id: int) -> None:
        """Hide every cell that older batches put under the listed keys."""
        self.write(keys.select(F.col(f"`{self.key}`")), batch_id, gone=True)
        self.commit(batch_id, [], gone=True)

    # Reads

    def _schema(self, version: Version) -> T.StructType:
        listed = ", ".join(f"`{c}` {t}" for c, t in version.columns.items())
        return T.StructType.fromDDL(f"{listed}, {_OWN}")

    def _columns(self, version: Version) -> list[str]:
        return [c for c in version.columns if c not in (self.key, "_arrival")]

    def _empty(self, schema: T.StructType) -> DataFrame:
        return self.spark.createDataFrame([], schema)

    def _base(self, version: Version, buckets: list[int] | None) -> DataFrame:
        """The merged rows, as of each bucket's last compaction."""
        schema = self._schema(version)
        chosen = {b: v[0] for b, v in version.bases.items() if v[0] and (buckets is None or b in buckets)}
        found = None
        for folder in sorted(set(chosen.values())):
            rows = self.spark.read.schema(schema).parquet(f"{self.path}/bases/{folder}")
            own = [b for b, f in chosen.items() if f == folder]
            rows = rows if set(own) == set(range(version.buckets)) else rows.filter(F.col("_bucket").isin(own))
            found = rows if found is None else found.unionByName(rows)
        return self._empty(schema) if found is None else found

    def _recent(self, version: Version, batches: dict[int, dict], buckets: list[int] | None) -> DataFrame:
        """The batches that some bucket has not merged yet, without those a bucket has."""
        schema = T.StructType([*self._schema(version).fields, T.StructField("batch_id", T.IntegerType())])
        folders = [f"{self.path}/batches/batch_id={n}" for n in batches]
        if not folders:
            return self._empty(schema)
        rows = self.spark.read.schema(schema).option("basePath", f"{self.path}/batches").parquet(*folders)
        if buckets is not None:
            rows = rows.filter(F.col("_bucket").isin(buckets))
        behind = min(batches) - 1
        ahead: dict[int, list[int]] = {}
        for b, (_, upto) in version.bases.items():
            if upto > behind:
                ahead.setdefault(upto, []).append(b)
        for upto, own in ahead.items():
            rows = rows.filter(~F.col("_bucket").isin(own) | (F.col("batch_id") > upto))
        return rows

    def _merge(self, rows: DataFrame, columns: list[str], whole: bool) -> DataFrame:
        """One row per key with ``_names``; ``whole`` says that every put wrote all columns."""
        order = ["batch_id", *(["_arrival"] if "_arrival" in rows.columns else []), "_tie"]
        if whole:
            place = [c for c in ("_bucket", "_part") if c in rows.columns]
            last = top_one_of_many(rows, [self.key], [F.col(c).desc() for c in order], dealt=tuple(place))
            return last.filter("NOT _gone").select(self.key, *columns, "_names", *place)
        gone = F.max(F.when(F.col("_gone"), F.col("batch_id"))).alias("_hidden")
        cells = [F.max(F.when(F.array_contains("_names", c), F.struct(*order, F.col(f"`{c}`").alias("v")))).alias(c) for c in columns]
        put = F.max(F.when(~F.col("_gone"), F.col("batch_id"))).alias("_put")
        merged = rows.groupBy(self.key).agg(gone, put, *cells)
        hidden = F.coalesce("_hidden", F.lit(-2))

        def shown(c: str) -> Column:
            return F.coalesce(F.col(f"`{c}`.batch_id") > hidden, F.lit(False))

        names = F.filter(F.array(*[F.when(shown(c), c) for c in columns]), lambda n: n.isNotNull()) if columns else F.array().cast("array<string>")
        return merged.filter(F.col("_put") > hidden).select(
            self.key, *[F.when(shown(c), F.col(f"`{c}`.v")).alias(c) for c in columns], names.alias("_names"))

    def _first_base(self, version: Version, batches: dict[int, dict], buckets: list[int]) -> DataFrame | None:
        """The merged rows of buckets without a base and of batches of whole rows: dealt, without the names, which are all columns.

        The rows of a single batch that holds each key once lie in their buckets already and are not exchanged.
        """
        columns = self._columns(version)
        if any(b in version.bases for b in buckets) or any(not b["gone"] and set(b["columns"]) != set(columns) for b in batches.values()):
            return None
        recent = self._recent(version, batches, None if len(buckets) == version.buckets else buckets)
        if [b.get("once") and not b["gone"] for b in batches.values()] == [True]:
            return recent.select(self.key, *columns, "_bucket")
        return self._merge(self._placed(recent, version), columns, True).drop("_names").repartition("_bucket", "_part")

    def _rows(self, version: Version, columns: list[str], buckets: list[int] | None = None, key_is: Column | None = None,
              batches: dict[int, dict] | None = None) -> DataFrame:
        if batches is None:
            batches = self.batches(version)[1]
        base, recent = self._base(version, buckets), self._recent(version, batches, buckets)
        if key_is is not None:
            base, recent = base.filter(key_is), recent.filter(key_is)
        base = base.select(self.key, *columns, "_names")
        if not batches:
            return base
        based = any(v[0] for b, v in version.bases.items() if buckets is None or b in buckets)
        arrival = ["_arrival"] if "_arrival" in recent.columns else []
        recent = recent.select(self.key, *columns, "_names", "_gone", "_tie", "batch_id", *arrival)
        if key_is is not None:  # few rows: merged without looking which keys are touched
            return self._merge(recent.unionByName(self._older(base, recent)), columns, False)
        whole = set(self._columns(version))
        as_rows = all(b["gone"] or set(b["columns"]) == whole for b in batches.values())
        if as_rows:
            # A put replaces the row, so the rows of the bases are needed only for keys that no batch touches.
            merged = self._merge(recent, columns, True)
            return self._untouched(base, recent).unionByName(merged) if based else merged
        listed = recent.select(self.key)
        old = lookup(base, listed.distinct(), [self.key], self.policy, "left_semi", bound=listed)
        return self._untouched(base, recent).unionByName(self._merge(recent.unionByName(self._older(old, recent)), columns, False))

    def _older(self, base: DataFrame, recent: DataFrame) -> DataFrame:
        """Rows of the bases as puts before every batch."""
        arrival = {"_arrival": F.lit(None).cast(recent.schema["_arrival"].dataType)} if "_arrival" in recent.columns else {}
        return base.withColumns({"_gone": F.lit(False), "_tie": F.lit(0).cast("long"), "batch_id": F.lit(-1), **arrival})

    def _untouched(self, base: DataFrame, recent: DataFrame) -> DataFrame:
        listed = recent.select(self.key)
        return lookup(base, listed.distinct(), [self.key], self.policy, "left_anti", bound=listed)

    def view(self, columns: list[str] | None = None) -> DataFrame:
        """Key and cells of every key; a cell that was never written is NULL. Only the asked columns are read."""
        version = self.version()
        if version is None:
            raise ValueError(f"nothing was put into {self.path}")
        columns = self._columns(version) if columns is None else columns
        return self._rows(version, columns).select(self.key, *columns)

    def row(self, row_key, columns: list[str] | None = None) -> DataFrame:
        """The view of one key: opens its bucket only."""
        version = self.version()
        columns = self._columns(version) if columns is None else columns
        literal = F.lit(row_key).cast(version.columns[self.key])
        # The bucket is a constant, so the scan lists its files only.
        own = F.col("_bucket") == self._bucket(literal, version.buckets)
        return self._rows(version, columns, key_is=own & (F.col(f"`{self.key}`") == literal))

    def read_cell(self, row_key, column: str) -> DataFrame:
        """One row, column ``value``: the cell as text, empty where there is none."""
        return self.row(row_key, [column]).agg(F.coalesce(F.max(F.col(f"`{column}`").cast("string")), F.lit("")).alias("value"))

    def cell_exists(self, row_key, column: str) -> DataFrame:
        """One row, column ``found``: whether a visible put wrote the cell."""
        return self.row(row_key, [column]).filter(F.array_contains("_names", column)).agg((F.count("*") > 0).alias("found"))

    def base_sql(self, columns: dict[str, str]) -> str:
        """SQL text that selects expressions under names from the bases of the newest version, for views that outlast the session."""
        version = self.version()
        listed = ", ".join(f"{e} AS `{n}`" for n, e in columns.items())
        folders: dict[str, list[int]] = {}
        for b, (folder, _) in version.bases.items():
            if folder:
                folders.setdefault(folder, []).append(b)
        if not folders:
            typed = ", ".join(f"CAST(NULL AS {t}) AS `{c}`" for c, t in version.columns.items())
            return f"SELECT {listed} FROM (SELECT {typed}) WHERE false"
        return " UNION ALL ".join(f"SELECT {listed} FROM parquet.`{self.path}/bases/{f}` WHERE _bucket IN ({', '.join(map(str, own))})"
                                  for f, own in sorted(folders.items()))

    # Maintenance

    def compact(self, buckets: list[int] | None = None) -> None:
        """Merge the committed batches of some buckets (all by default) into new bases, and publish them.

        Other buckets, and batches that are committed meanwhile, are left alone. Deletions are merged away.
        """
        version = self.version()
        if version is None:
            return
        _, batches = self.batches(version)
        if not batches:
            return
        own = list(range(version.buckets)) if buckets is None else sorted(buckets)
        upto, folder = max(batches), uuid.uuid4().hex
        columns, added = self._columns(version), {"_gone": F.lit(False), "_tie": F.lit(0).cast("long")}
        rows = self._first_base(version, batches, own)
        if rows is None:
            rows = self._placed(self._rows(version, columns, own, batches=batches), version).repartition("_bucket", "_part")
        else:
            added["_names"] = F.array(*map(F.lit, columns)) if columns else F.array().cast("array<string>")
        self._files(rows, f"{self.path}/bases/{folder}", added)
        there = {int(n.split("=")[1]) for n in publish.names(self.spark, f"{self.path}/bases/{folder}") if n.startswith("_bucket=")}

        def swap(current: Version) -> Version:
            if any(current.bases.get(b) != version.bases.get(b) for b in own):
                raise RuntimeError("another compaction of these buckets was published first")
            merged = {b: (folder if b in there else "", upto) for b in own}
            return replace(current, bases={**current.bases, **merged})

        self._change(swap)

    def vacuum(self) -> None:
        """Remove batches that all buckets have merged and bases that the newest version does not name.

        Call it when no reader follows an older version any more. The marks stay: they tell other tables of a run which batches are whole.
        """
        version = self.version()
        upto, _ = self.batches(version)
        kept = {v[0] for v in version.bases.values()}
        for name in publish.names(self.spark, f"{self.path}/bases"):
            if name not in kept:
                publish.remove(self.spark, f"{self.path}/bases/{name}")
        for n in self.committed():
            if n <= upto:
                publish.remove(self.spark, f"{self.path}/batches/batch_id={n}")
