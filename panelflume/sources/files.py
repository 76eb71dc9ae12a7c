"""File sources and sinks: typed CSV and JSON scans, optional tables, partitioned result export."""
from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType


def read_csv(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """Typed CSV scan with header. Nothing is inferred; a missing path fails when the plan is built."""
    return spark.read.schema(schema).option("header", True).option("mode", "FAILFAST").csv(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def read_json(spark: SparkSession, path: str, schema: StructType | str, multi_line: bool = False) -> DataFrame:
    """JSON scan. Line-delimited files split over tasks; multi_line reads each file whole, for small documents."""
    return spark.read.schema(schema).option("multiLine", multi_line).option("mode", "FAILFAST").json(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def read_optional(spark: SparkSession, path: str, schema: StructType | str, fmt: str = "parquet") -> DataFrame:
    """Scan a table that may be absent; an absent one gives zero rows of the schema."""
    reader = spark.read.schema(schema)
    if fmt == "csv":
        reader = reader.option("header", True)
    try:
        return reader.format(fmt).load(path)
    except AnalysisException as err:
        if err.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def json_arrays(rows: DataFrame, entities: DataFrame, key: str, order: str) -> DataFrame:
    """(key, records): each entity's rows as one JSON array in order; `[]` for an entity without rows.

    An array holds one entity's rows, so it is for tables of bounded length per entity, such as result tables.
    """
    packed = rows.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(order, *[c for c in rows.columns if c not in (key, order)]))).alias("_rows"))
    return entities.select(key).distinct().join(packed, key, "left").select(key, F.coalesce(F.to_json("_rows"), F.lit("[]")).alias("records"))


def write_results(tables: dict[str, DataFrame], folder: str, partition_key: str = "route",
                  partitioned: frozenset[str] = frozenset({"forecasts", "decompositions"})) -> None:
    """Export named result tables as parquet; the long ones are laid out by entity.

    Rows of an entity are not gathered in one task first: each task writes its own file per entity.
    """
    for name, df in tables.items():
        writer = df.write.mode("overwrite")
        if name in partitioned and partition_key in df.columns:
            writer = writer.partitionBy(partition_key)
        writer.parquet(f"{folder}/{name}")


def export(tables: dict[str, DataFrame], folder: str, partition_key: str = "route", replace: bool = False) -> int:
    """Writes a version of named tables; readers see all of it or nothing. Returns the version's number.

    Tables go to a staged folder of their own first. The manifest of the version is written last and is the commit: a run that
    fails before leaves what was readable as it was. With `replace` only the entities in the given rows are replaced, in the
    given tables; files of other entities and tables are not touched. One writer at a time.
    """
    spark = next(iter(tables.values())).sparkSession
    version = max([v for v, _ in _manifests(spark, folder)], default=0) + 1
    staged = f"{folder}/runs/{uuid.uuid4().hex}"
    rows = []
    for name, df in tables.items():
        df.write.parquet(f"{staged}/{name}")
        if replace:
            spark.read.parquet(f"{staged}/{name}").select(partition_key).distinct().write.parquet(f"{staged}/{name}_keys")
        rows.append((name, f"{staged}/{name}", replace))
    manifest = spark.createDataFrame(rows, "name string, path string, replaces boolean")
    manifest.coalesce(1).write.json(f"{folder}/manifests/version={version}")
    return version


def _manifests(spark: SparkSession, folder: str) -> list[tuple[int, str]]:
    """(version, path) of committed manifests, in order."""
    hadoop, conf = spark._jvm.org.apache.hadoop.fs, spark._jsparkSession.sessionState().newHadoopConf()
    top = hadoop.Path(f"{folder}/manifests")
    files = top.getFileSystem(conf)
    if not files.exists(top):
        return []
    found = [s.getPath() for s in files.listStatus(top)]
    done = [p for p in found if files.exists(hadoop.Path(p, "_SUCCESS"))]
    return sorted((int(p.getName()[len("version="):]), p.toString()) for p in done)


def read_export(spark: SparkSession, folder: str, name: str, version: int | None = None, partition_key: str = "route") -> DataFrame:
    """A table of the last committed version, or of an earlier one: its last whole run with the entities replaced since."""
    runs = []
    for v, path in _manifests(spark, folder):
        if version is None or v <= version:
            rows = spark.read.schema("name string, path string, replaces boolean").json(path).filter(F.col("name") == name)
            runs += [(r["path"], r["replaces"]) for r in rows.collect()]
    whole = [i for i, (_, replaces) in enumerate(runs) if not replaces]
    if not whole:
        raise FileNotFoundError(f"no committed run of {name} in {folder}")
    out = spark.read.parquet(runs[whole[-1]][0])
    for path, _ in runs[whole[-1] + 1:]:
        keys = spark.read.parquet(f"{path}_keys").select(F.col(partition_key).alias("replaced_"))
        out = out.join(keys, out[partition_key].eqNullSafe(F.col("replaced_")), "left_anti").unionByName(spark.read.parquet(path))
    return out


def shared_folder(spark: SparkSession, work_dir: str | None = None) -> str:
    """A fresh folder under work_dir, else under spark.checkpoint.dir, else under the warehouse: all of them shared by the
    executors, under any master."""
    root = work_dir or spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir')}/scratch"
    return f"{root.rstrip('/')}/panelflume-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame, work_dir: str | None = None) -> DataFrame:
    """Write df to the shared folder and read it back, so that later jobs neither repeat nor depend on its plan.

    The written table outlives executors, and its files are sized by their bytes, however many tasks computed them.
    """
    folder = shared_folder(df.sparkSession, work_dir)
    df.hint("rebalance").write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)
