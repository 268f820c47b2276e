"""Reading and writing of cell tables, batches and published layouts."""

from __future__ import annotations

import tempfile
import uuid
import fnmatch
import re
from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assayframe.functions.columns import embeddings, metadata, non_finite_to_null

SUFFIXES = {".csv": "csv", ".tsv": "csv", ".parquet": "parquet", ".parq": "parquet", ".pq": "parquet"}


def kind_of(path: str) -> str:
    bare = path.removesuffix(".gz").rstrip("/")
    for suffix, kind in SUFFIXES.items():
        if bare.endswith(suffix):
            return kind
    raise ValueError(f"neither CSV nor Parquet by its name: {path}")


def scan(spark: SparkSession, path: str, sample: float = 1.0, text_only: bool = False, file_column: str = "meta_source_file", row_column: str = "meta_source_file_idx") -> DataFrame:
    """A CSV, TSV or Parquet table with the file and the row's place in it.

    Parquet rows carry their index; rows of text files are numbered by file in
    two passes, counts per partition and then offsets, so no file's rows meet.
    """
    if kind_of(path) == "parquet":
        df = spark.read.parquet(path)
        return df.select("*", F.col("_metadata.file_path").alias(file_column), F.col("_metadata.row_index").alias(row_column))
    reader = spark.read.option("header", True).option("sep", "\t" if ".tsv" in path else ",")
    reader = reader.option("positiveInf", "inf").option("negativeInf", "-inf").option("inferSchema", not text_only).option("samplingRatio", sample)
    df = reader.csv(path).select("*", F.col("_metadata.file_path").alias(file_column), F.monotonically_increasing_id().alias("__id"))
    return _numbered(df, [file_column], row_column)


def _numbered(df: DataFrame, by: list[str], to: str) -> DataFrame:
    """``to``: 0, 1, ... in the order of ``__id`` within ``by``; ids of a partition share their upper bits."""
    part = F.shiftright("__id", 33)
    sizes = df.groupBy(*by, part.alias("__part")).agg(F.count("*").alias("__n"), F.min("__id").alias("__first"))
    before = F.coalesce(F.sum("__n").over(Window.partitionBy(*by).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = sizes.select(*(F.col(b).alias(f"__{b}") for b in by), F.col("__part").alias("__p"), "__first", before.alias("__before"))
    on = [F.col(b) == F.col(f"__{b}") for b in by] + [part == F.col("__p")]
    # rows of one file stand together in a partition, so ids within (file, partition) have no gaps
    out = df.join(F.broadcast(starts), on).withColumn(to, F.col("__before") + F.col("__id") - F.col("__first"))
    return out.select(*(c for c in df.columns if c != "__id"), to)


def load_and_tag(spark: SparkSession, path: str, sample: float = 1.0) -> DataFrame:
    """A table with ``origin_file, origin_row_idx``, non-finite values null and wide integers as long."""
    df = non_finite_to_null(scan(spark, path, sample, file_column="origin_file", row_column="origin_row_idx"))
    wide = {f.name for f in df.schema if isinstance(f.dataType, T.DecimalType) and f.dataType.scale == 0}
    return df.select(*(F.col(c).cast("long").alias(c) if c in wide else F.col(c) for c in df.columns))


def concat(tables: Sequence[DataFrame]) -> tuple[DataFrame, list[list[str]]]:
    """Union by name, missing columns null and types widened; and the columns that each table lacked."""
    names = list(dict.fromkeys(c for t in tables for c in t.columns))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables), [[c for c in names if c not in t.columns] for t in tables]


def combine_cells(tables: Sequence[DataFrame], index: str | None = None) -> DataFrame:
    """Vertical union; ``index`` numbers the rows in the order of tables and rows."""
    rows = [t.withColumn("__table", F.lit(i)) for i, t in enumerate(tables)]
    df, _ = concat(rows)
    if index is None:
        return df.drop("__table")
    df = df.withColumn("__id", F.monotonically_increasing_id()).withColumn("__all", F.lit(0))
    return _numbered(df, ["__all"], index).drop("__table", "__all")


def load_batches(spark: SparkSession, glob: str, parent_name: bool = False) -> DataFrame:
    """Parquet files of a glob with ``meta_batch``: each file's stem or its folder's name; no match is an error."""
    file = F.col("_metadata.file_path")
    pattern = r"([^/]+)/[^/]+$" if parent_name else r"([^/]+)\.[^./]+$"
    return spark.read.parquet(glob).select("*", F.regexp_extract(file, pattern, 1).alias("meta_batch"))


def natural_order(names: Iterable[str]) -> list[str]:
    """``T2`` before ``T10``."""
    return sorted(names, key=lambda n: [(int(p), "") if p.isdigit() else (-1, p) for p in re.findall(r"\d+|\D+", n)])


def select_batches(found: Iterable[str], wanted: Sequence[str] | None = None, exclude: Sequence[str] = ()) -> list[str]:
    """Batches in natural order; wanted ones must exist; ``exclude`` holds globs, or patterns in slashes."""
    found = natural_order(set(found))
    if wanted is not None:
        if missing := [w for w in wanted if w not in found]:
            raise ValueError(f"no such batches: {', '.join(missing)}")
        found = [f for f in found if f in wanted]
    out = lambda n: any(re.search(e[1:-1], n) if len(e) > 1 and e[0] == e[-1] == "/" else fnmatch.fnmatchcase(n, e) for e in exclude)
    return [f for f in found if not out(f)]


def batch_aggregates(spark: SparkSession, root: str, label: str, types: Sequence[str] | None = None, experiment: str | None = None) -> DataFrame:
    """One row per label and experiment from ``root/experiment=.../method=.../``: each method's value columns joined on both.

    Only the folders of the wanted experiment and methods are read.
    """
    df = spark.read.option("mergeSchema", True).parquet(root)
    df = df if experiment is None else df.where(F.col("experiment") == experiment)
    methods = list(types) if types is not None else [r[0] for r in df.select("method").distinct().orderBy("method").collect()]
    values = [c for c in df.columns if c not in (label, "experiment", "method")]
    picked = [F.max(F.when(F.col("method") == m, F.col(v))).alias(f"{v}_{m}") for m in methods for v in values]
    whole = F.count_distinct("method") == len(methods)
    return df.where(F.col("method").isin(methods)).groupBy(label, "experiment").agg(*picked, whole.alias("__whole")).where("__whole").drop("__whole")


def write_sorted(df: DataFrame, path: str, keys: Sequence[str], partitions: Sequence[str] = ()) -> None:
    """Parquet in key order, nulls first: a range per file, so the order costs one exchange."""
    order = [F.asc_nulls_first(k) for k in keys]
    writer = df.orderBy(*(F.asc_nulls_first(p) for p in partitions), *order).write.mode("overwrite")
    (writer.partitionBy(*partitions) if partitions else writer).parquet(path)


def table_path(root: str, stage: str, experiment: str, method: str | None = None, replicate: int | None = None, half: int | None = None) -> str:
    """The place of a stage's table in the published layout."""
    parts = [root.rstrip("/"), stage, f"experiment={experiment}"]
    parts += [f"{k}={v}" for k, v in (("method", method), ("replicate", replicate), ("half", half)) if v is not None]
    return "/".join(parts)


def canonical_identity(df: DataFrame, barcode: str, label: str, distance: str, wildtype: str | None = None, tag: str | None = None) -> DataFrame:
    """The three identity columns under their canonical names and types; an edit distance with a fraction is an error.

    With ``tag``, what follows a label's first colon goes to that column (null
    without one), and only what comes before stays in the label.
    """
    d = F.col(distance).cast("double")
    whole = F.when(d.isNotNull() & (d != F.floor(d)), F.raise_error(F.lit("an edit distance has a fraction"))).otherwise(d).cast("long")
    name = F.col(label).cast("string")
    parts = F.split(name, ":", 2)
    name = F.get(parts, F.lit(0)) if tag else name
    out = {"meta_barcode": F.col(barcode).cast("string"), "meta_aa_changes": F.when(name == wildtype, "WT").otherwise(name) if wildtype else name, "meta_edit_distance": whole} | ({tag: F.get(parts, F.lit(1))} if tag else {})
    return df.select(*(c.alias(n) for n, c in out.items()), *(c for c in df.columns if c not in (barcode, label, distance, tag)))


def older_names(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Renames columns of older results where the new name is absent."""
    return df.withColumnsRenamed({old: new for old, new in names.items() if old in df.columns and new not in df.columns})


def concat_embeddings(tables: Sequence[DataFrame], fixed: Sequence[str]) -> DataFrame:
    """Union of embedding tables: fixed metadata first, other metadata, then ``emb_*`` in their order."""
    df, _ = concat(tables)
    rest = [c for c in metadata(df) if c not in fixed]
    return df.select(*(c for c in fixed if c in df.columns), *rest, *natural_order(embeddings(df)))


def shard_ids(df: DataFrame, well: str, order: str, size: str, limit: int) -> DataFrame:
    """``shard`` of each sample: packed per well in order, a shard closing with the sample that reaches ``limit`` bytes.

    Only order and size of a well's samples meet in a task, not the samples.
    """

    def pack(group):
        group = group.sort_values("ord", kind="stable")
        shards, shard, filled = [], 0, 0
        for n in group["bytes"]:
            shards.append(shard)
            filled += n
            if filled >= limit:
                shard, filled = shard + 1, 0
        return group.assign(shard=shards)

    slim = df.select(F.col(well).alias("well"), F.col(order).alias("ord"), F.col(size).cast("long").alias("bytes"))
    schema = T.StructType([*slim.schema.fields, T.StructField("shard", T.LongType())])
    packed = slim.groupBy("well").applyInPandas(pack, schema).select(F.col("well").alias("__w"), F.col("ord").alias("__o"), "shard")
    return df.join(packed, F.col(well).eqNullSafe(F.col("__w")) & F.col(order).eqNullSafe(F.col("__o"))).drop("__w", "__o")


#: Parts of a nested variant record that are read.
VARIANT = "struct<data:struct<gene:struct<variants:array<struct<variant_id:string,hgvsp:string,joint:struct<ac:long,an:long,filters:array<string>>,exome:struct<ac:long,an:long,filters:array<string>>,genome:struct<ac:long,an:long,filters:array<string>>,in_silico_predictors:array<struct<id:string,value:string>>>>>>>"


def api_variants(payloads: DataFrame, text: str, predictor: str) -> DataFrame:
    """Rows of a nested payload: the joint, exome or genome call set, PASS when there is no filter, one predictor's value."""
    v = F.explode(F.from_json(text, VARIANT)["data"]["gene"]["variants"]).alias("v")
    rows = payloads.select(v)
    call = F.coalesce("v.joint", "v.exome", "v.genome")
    value = F.get(F.filter("v.in_silico_predictors", lambda p: p["id"] == predictor), F.lit(0))["value"]
    filters = F.when(F.size(call["filters"]) > 0, F.array_join(call["filters"], "|")).otherwise("PASS")
    return rows.select("v.variant_id", "v.hgvsp", call["ac"].alias("ac"), call["an"].alias("an"), filters.alias("filters"), value.alias(predictor))


def condition_names(text: Column, uninformative: Sequence[str] = ("not provided", "not specified")) -> Column:
    """Trait names of a JSON list, without repeats and uninformative ones, in order."""
    names = F.transform(F.from_json(text, "array<struct<trait_name:string>>"), lambda t: t["trait_name"])
    return F.array_distinct(F.filter(names, lambda n: n.isNotNull() & ~n.isin(*uninformative)))


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the folder of ``spark.checkpoint.dir``, which the cluster's nodes share; a temporary one only where that is unset, as in tests."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = f"file://{tempfile.mkdtemp(prefix='spark-shared-')}"
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str = "step") -> DataFrame:
    """``df`` written to the shared folder and read back: a plan of its own, which outlives lost executors."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
