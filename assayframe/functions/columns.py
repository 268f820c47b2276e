"""Column rules: every ``meta_`` column is metadata, every other one a feature."""

from __future__ import annotations

import fnmatch
import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

META = "meta_"
EMBEDDING = re.compile(r"^emb_\d+$")


def features(df: DataFrame) -> list[str]:
    return [c for c in df.columns if not c.startswith(META)]


def metadata(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c.startswith(META)]


def embeddings(df: DataFrame) -> list[str]:
    return [c for c in df.columns if EMBEDDING.match(c)]


def chosen(names: Iterable[str], allow: Iterable[str] | None = None, block: Iterable[str] = ()) -> list[str]:
    """Names that match a pattern of ``allow`` (if given) and none of ``block``."""
    names, allow, block = list(names), None if allow is None else list(allow), list(block)
    hit = lambda n, globs: any(fnmatch.fnmatchcase(n, g) for g in globs)
    return [n for n in names if (allow is None or hit(n, allow)) and not hit(n, block)]


def keep_features(df: DataFrame, patterns: Iterable[str]) -> DataFrame:
    return df.select(*metadata(df), *chosen(features(df), patterns))


def drop_features(df: DataFrame, patterns: Iterable[str]) -> DataFrame:
    return df.select(*metadata(df), *chosen(features(df), None, patterns))


def finite(column: Column | str) -> Column:
    """The value if it is finite, else null."""
    c = (F.col(column) if isinstance(column, str) else column).cast("double")
    return F.when(~F.isnan(c) & (F.abs(c) < float("inf")), c)


def non_finite_to_null(df: DataFrame) -> DataFrame:
    """NaN and infinities of all floating columns become null, in one projection."""
    floats = {f.name for f in df.schema if f.dataType.typeName() in ("float", "double")}
    return df.select(*(finite(c).cast(df.schema[c].dataType).alias(c) if c in floats else F.col(c) for c in df.columns))


def drop_non_finite(df: DataFrame) -> DataFrame:
    """Drops features with any null, NaN or infinite value; one pass counts them all."""
    own = features(df)
    bad = df.agg(*(F.count_if(finite(c).isNull()).alias(c) for c in own)).first() if own else {}
    return df.drop(*(c for c in own if bad[c]))


def drop_non_finite_rows(df: DataFrame) -> DataFrame:
    """Drops rows without any finite feature."""
    return df.where(F.coalesce(*(finite(c) for c in features(df)), F.lit(None).cast("double")).isNotNull())


def common_features(batches: dict[str, DataFrame]) -> tuple[list[str], dict[str, list[str]]]:
    """Features of every batch, in the first one's order, and what each batch has besides."""
    shared = [c for c in features(next(iter(batches.values()))) if all(c in b.columns for b in batches.values())]
    if not shared:
        raise ValueError("the batches have no feature in common")
    return shared, {name: [c for c in features(b) if c not in shared] for name, b in batches.items()}


def parse_feature(name: Column) -> Column:
    """Struct of a feature's base, statistic, compartment and category, by its underscore-separated name."""
    statistic = F.nullif(F.regexp_extract(name, r"_(mean|median|MAD|std|KS|signedKS|QQ|AUROC|KSnegLogP|AUROCnegLogP)$", 1), F.lit(""))
    base = F.when(statistic.isNull(), name).otherwise(F.substring(name, F.lit(1), F.length(name) - F.length(statistic) - 1))
    part = lambda i: F.try_element_at(F.split(base, "_"), F.lit(i))
    return F.struct(base.alias("base"), statistic.alias("statistic"), part(1).alias("compartment"), part(2).alias("category"))


def natural_key(text: Column) -> Column:
    """Sort key by which digits compare as numbers (of up to 20 digits)."""
    parts = F.regexp_extract_all(text, F.lit(r"(\d+|\D+)"), F.lit(1))
    return F.transform(parts, lambda p: F.when(p.rlike(r"^\d"), F.lpad(F.regexp_replace(p, "^0+(?=.)", ""), 20, "0")).otherwise(p))


def output_columns(df: DataFrame, identity: Iterable[str], known: Iterable[str] = (), allow: Iterable[str] | None = None, block: Iterable[str] = ()) -> DataFrame:
    """Identity, metadata (the ``known`` ones get the prefix) and the features that patterns choose: those of ``allow`` first, less those of ``block``."""
    identity, known = list(identity), [k for k in known if k in df.columns]
    meta = [c for c in df.columns if c.startswith(META) and c not in identity]
    own = [c for c in df.columns if c not in {*identity, *known, *meta}]
    return df.select(*identity, *meta, *(F.col(k).alias(META + k) for k in known), *chosen(own, allow, block))


#: Metadata of a cell and their types.
CELL_METADATA = {"meta_batch": "string", "meta_well": "string", "meta_tile": "string", "meta_cell_index": "bigint", "meta_barcode": "string", "meta_aa_changes": "string", "meta_edit_distance": "bigint"}


def cell_metadata(df: DataFrame, batch: str, measures: bool = False) -> DataFrame:
    """The metadata of cells in their types, the batch being given, and with ``measures`` all columns that aren't metadata."""
    own = [F.lit(batch).alias("meta_batch"), *(F.col(c).cast(t).alias(c) for c, t in CELL_METADATA.items() if c != "meta_batch")]
    return df.select(*own, *(features(df) if measures else []))


def with_residue(df: DataFrame, position: str, offset: int, kinds: Iterable[str] | None = None, kind: str = "variant_type", to: str = "residue") -> DataFrame:
    """Rows of some classes (of all by default) with the residue that a position stands for."""
    rows = df if kinds is None else df.where(F.col(kind).isin(*kinds))
    return rows.withColumn(to, F.col(position) + offset)


def landmark_columns(names: Iterable[str], landmarks: dict[str, str]) -> dict[str, str]:
    """Readable names of the columns ``<landmark>_<statistic>``, in the landmarks' order, the median first."""
    names, out = list(names), {}
    for key, title in landmarks.items():
        own = [(n, n.removeprefix(f"{key}_")) for n in names if n.startswith(f"{key}_")]
        own = [(n, kind) for n, kind in own if kind.isalnum()]
        out |= {n: f"{title} ({kind})" for n, kind in sorted(own, key=lambda x: x[1] != "median")}
    return out
