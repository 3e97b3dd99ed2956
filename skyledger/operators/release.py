"""Checksummed releases of product files: build, validate, promote."""

from __future__ import annotations

import json
import os
import shutil
from datetime import UTC, datetime
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger import schema
from skyledger.operators.footers import file_statistics


def file_hashes(spark: SparkSession, pattern: str) -> DataFrame:
    """(path, sha256) of files, hashed on executors."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(pattern)
    return files.select(F.regexp_replace("path", "^file:", "").alias("path"), F.sha2("content", 256).alias("sha256"))


def file_facts(spark: SparkSession, pattern: str) -> DataFrame:
    """(path, row_count, date_min, date_max, qc_summary) of Parquet files: counts and days from the footers, and the states
    from a scan of that one column."""
    df = spark.read.option("recursiveFileLookup", "true").parquet(pattern)
    ts = next((c for c in ("date", "datetime_utc") if c in df.columns), None)
    plain = F.regexp_replace("path", "^file:(//)?", "").alias("path")
    facts = file_statistics(spark, pattern, ts).select(plain, F.col("n_rows").alias("row_count"), F.to_date("low").alias("date_min"), F.to_date("high").alias("date_max"))
    state = F.coalesce("qc_state", F.lit("missing")) if "qc_state" in df.columns else F.lit("pass")
    counts = df.select(F.col("_metadata.file_path").alias("path"), state.alias("s")).groupBy("path", "s").agg(F.count(F.lit(1)).alias("n"))
    states = counts.groupBy("path").agg(F.to_json(F.map_from_entries(F.sort_array(F.collect_list(F.struct("s", "n"))))).alias("qc_summary"))
    return facts.join(states.select(plain, "qc_summary"), "path", "left")


def build_release(spark: SparkSession, root: str, version: str, channel: str, products: dict[str, str], provenance: dict | None = None) -> Path:
    """Links (or copies) each product's Parquet files to root/version, writes manifest.parquet and release.json, and
    points root/channel to it."""
    base = Path(root) / version
    if base.exists():
        raise ValueError(f"release {version} exists")
    for product, folder in products.items():
        for f in sorted(Path(folder).rglob("*.parquet")):
            if f.is_file():
                to = base / product / f.relative_to(folder)
                to.parent.mkdir(parents=True, exist_ok=True)
                try:
                    os.link(f, to)
                except OSError:
                    shutil.copy2(f, to)
    parts = [p for p in products if (base / p).exists()]
    rows = []
    if parts:
        for p in parts:
            at = str(base / p)
            rel = F.regexp_replace("path", f"^.*?{base.name}/", "")
            rows.append(file_hashes(spark, at).join(file_facts(spark, at), "path", "left").select(F.lit(p).alias("product"), rel.alias("path"), "sha256", "row_count", "date_min", "date_max", "qc_summary"))
        out = rows[0]
        for r in rows[1:]:
            out = out.unionByName(r)
    else:
        base.mkdir(parents=True)
        out = spark.createDataFrame([], schema.RELEASE)
    out.select(*schema.RELEASE.names).coalesce(1).write.parquet(str(base / "_manifest"))
    meta = {"version": version, "channel": channel, "created_utc": datetime.now(UTC).isoformat(), "products": sorted(products), "provenance": provenance or {}}
    (base / "release.json").write_text(json.dumps(meta, indent=2, sort_keys=True))
    promote_link(root, version, channel)
    return base


def promote_link(root: str, version: str, channel: str) -> None:
    link, new = Path(root) / channel, Path(root) / f".{channel}.new"
    new.unlink(missing_ok=True)
    new.symlink_to(version)
    new.replace(link)


def validate_release(spark: SparkSession, root: str, version: str) -> list[str]:
    """What is missing or differs from the manifest."""
    base = Path(root) / version
    listed = spark.read.parquet(str(base / "_manifest")).select("product", "path", "sha256")
    products = [r[0] for r in listed.select("product").distinct().collect()]
    found = None
    for p in products:
        if (base / p).exists() and any((base / p).rglob("*.parquet")):
            h = file_hashes(spark, str(base / p)).select(F.regexp_replace("path", f"^.*?{base.name}/", "").alias("path"), F.col("sha256").alias("now"))
            found = h if found is None else found.unionByName(h)
    if found is None:
        found = listed.select("path", F.lit(None).cast("string").alias("now")).limit(0)
    bad = listed.join(found, "path", "left").where(~F.col("sha256").eqNullSafe(F.col("now"))).select("path", F.when(F.col("now").isNull(), "missing").otherwise("mismatch").alias("why"))
    return sorted(f"{r['why']}: {r['path']}" for r in bad.collect())


def promote_release(spark: SparkSession, root: str, version: str, channel: str) -> None:
    if bad := validate_release(spark, root, version):
        raise ValueError(f"release {version} is not valid: {'; '.join(bad[:5])}")
    promote_link(root, version, channel)
