"""Lookup sides stored as joins need them: reduced to one row per key, measured, in sorted buckets of the key.

A load writes them once per version, so a micro-batch neither reduces nor measures nor exchanges a side: it sends its own
rows to the side's buckets. All sides of a version have the same number of buckets, so sides with the same key share one
exchange of the flow. Sides whose keys begin with the merchant are there in buckets of the merchant too, so these share one as well
(``Lookups.together``).
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession

from netledger.operators.joins import measure
from netledger.plans.settlement import (HOME, INCRE, NORMAL, SIDE_KEYS, SIDES, Dimensions, by_merchant, of_merchant,
                                        reduced, stored_name)
from netledger.sinks import publish

BUCKET_BYTES = 128 << 20


def write_sides(dims: Dimensions, target: str, buckets: int | None = None) -> int:
    """Store and publish the reduced sides of both flows; returns the number of the publication.

    ``buckets`` is by default one per 128 MB of the largest side, and at least the session's shuffle partitions where the sides take
    more than one bucket, as the flow is joined in as many tasks. Of two writers the one that claims its number second publishes
    under the next, unless the newest publication has all of its versions already.
    """
    spark = dims.fees.sparkSession
    sides = {stored_name(name, job): (reduced(dims, job, name), SIDE_KEYS[name]) for job in (NORMAL, INCRE) for name in SIDES}
    sizes = measure({name: side for name, (side, _) in sides.items()})
    if buckets is None:
        buckets = -(-max(sizes.values()) // BUCKET_BYTES) or 1
        if buckets > 1:
            buckets = max(buckets, int(spark.conf.get("spark.sql.shuffle.partitions")))
    load = uuid.uuid4().hex
    homes = {stored_name(name, job): by_merchant(reduced(dims, job, name), SIDE_KEYS[name])
             for job in (NORMAL, INCRE) for name in of_merchant(job) if SIDE_KEYS[name] != SIDE_KEYS["groups"]}
    for kind, tables in (("sides", sides), ("homes", {name: (side, HOME) for name, side in homes.items()})):
        for name, (side, key) in tables.items():
            table = f"netledger_{name}_{uuid.uuid4().hex}"
            (side.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key).format("parquet")
             .option("path", f"{target}/sides/{load}/{_folder(kind, name)}").saveAsTable(table))
            spark.sql(f"DROP TABLE {table}")  # the entry in the catalog; the files stay
    text = json.dumps({"versions": dims.version, "load": load, "buckets": buckets, "bytes": sizes,
                       "columns": {name: side.schema.toDDL() for name, (side, _) in sides.items()},
                       "homes": {name: side.schema.toDDL() for name, side in homes.items()}})
    while True:
        newest = publish.newest(spark, f"{target}/published/sides")
        if newest is not None and _covers(json.loads(newest[1])["versions"], dims.version):
            publish.remove(spark, f"{target}/sides/{load}")
            return newest[0]
        number = 0 if newest is None else newest[0] + 1
        if publish.claim(spark, f"{target}/published/sides", number, text):
            return number


def _folder(kind: str, name: str) -> str:
    return name if kind == "sides" else f"{name}_by_merchant"


def _covers(published: str, versions: str) -> bool:
    """Whether a publication was made from the same or newer versions of every table."""
    if not published or not versions:
        return False
    return all(int(p) >= int(v) for p, v in zip(published.split(","), versions.split(",")))


def sides_version(spark: SparkSession, target: str) -> str:
    """The number of the newest publication, from the names of small files."""
    numbers = [int(n) for n in publish.names(spark, f"{target}/published/sides") if n.isdigit()]
    return str(max(numbers, default=None))


def open_sides(spark: SparkSession, dims: Dimensions | None, target: str) -> Dimensions:
    """The newest stored sides; ``dims`` are the whole tables for other uses, where there are any."""
    newest = publish.newest(spark, f"{target}/published/sides")
    if newest is None:
        raise ValueError(f"no lookup sides are stored in {target}")
    number, text = newest[0], json.loads(newest[1])
    stored = {}
    for name, columns in text["columns"].items():
        key = SIDE_KEYS[name.split("_")[0]]
        stored[name] = (_bucketed(spark, f"{target}/sides/{text['load']}/{name}", columns, key, text["buckets"]), text["bytes"][name])
    # Publications of older loads have none.
    homes = {name: _bucketed(spark, f"{target}/sides/{text['load']}/{_folder('homes', name)}", columns, HOME, text["buckets"])
             for name, columns in text.get("homes", {}).items()}
    whole = (None,) * 4 if dims is None else (dims.codes, dims.groups, dims.mappings, dims.fees)
    return Dimensions(*whole, version=str(number), stored=stored, homes=homes or None, buckets=text["buckets"])


def _bucketed(spark: SparkSession, path: str, columns: str, key: str, buckets: int) -> DataFrame:
    """The files as a bucketed table. The catalog names it only while the plan is made, so sessions need not share a catalog."""
    table, location = f"netledger_{uuid.uuid4().hex}", path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet CLUSTERED BY ({key}) SORTED BY ({key}) INTO {buckets} BUCKETS "
              f"LOCATION '{location}'")
    try:
        return spark.table(table)
    finally:
        spark.sql(f"DROP TABLE {table}")
