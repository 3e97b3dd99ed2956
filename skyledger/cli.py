"""Command line: python -m skyledger.cli COMMAND ..."""

from __future__ import annotations

import argparse
import json
import urllib.request
from datetime import date

from pyspark.sql import functions as F

from skyledger import schema
from skyledger.operators import corrections, crosswalk, daily, diagnostics, fabric, manifest, por, release, rules, update, validation
from skyledger.session import get_session, ship
from skyledger.sources import acquire, readers, registry


def jobs_of(a: argparse.Namespace, opener=urllib.request.urlopen) -> list[acquire.Job]:
    """The files that ingest is asked for: of the named stations, or of all that the source lists."""
    root, names = a.root, (a.stations or "").split(",") if a.stations else []
    if not names and a.source in ("ghcnh", "ndbc", "raws", "snotel"):
        names = acquire.listed_stations(a.source, opener, regions=a.regions.split(",") if a.regions else acquire.RAWS_REGIONS)
    years = tuple(int(y) for y in a.years.split("-")) if a.years else (date.today().year,) * 2
    start, end = a.start or date(years[0], 1, 1), a.end or date.today()
    if a.source == "madis":
        jobs = acquire.madis_jobs(start, end, root)
        if a.user:
            jobs = [acquire.Job(j.key, tuple(acquire.basic_auth(u, a.user, a.password or "") for u in j.urls), j.to) for j in jobs]
        return jobs
    if a.source == "gdas":
        return acquire.gdas_jobs(start, end, root)
    by_name = {
        "isd": lambda: acquire.isd_jobs(acquire.isd_archive(range(years[0], years[-1] + 1), opener) if not names else [f"data/{y}/{n}-{y}.gz" for y in range(years[0], years[-1] + 1) for n in names], root), "ghcnh": lambda: acquire.ghcnh_jobs(names, root), "ndbc": lambda: acquire.ndbc_jobs(names, (years[0], years[-1]), root),
        "raws": lambda: [j for n in names for j in acquire.raws_jobs(n, start, end, root)], "snotel": lambda: [acquire.Job("inventory", (acquire.snotel_inventory(),), f"{root}/{readers.INVENTORY}"), *(j for n in names for j in acquire.snotel_jobs(n, start, end, root))],
    }
    if a.source not in by_name:
        raise KeyError(f"{a.source!r} has no download")
    return by_name[a.source]()


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="skyledger")
    sub = p.add_subparsers(dest="command", required=True)

    def command(name: str, *flags: str, positional: tuple[str, ...] = ()) -> None:
        c = sub.add_parser(name)
        for a in positional:
            c.add_argument(a)
        for f in flags:
            if f in ("overwrite", "dry-run", "keep-extra"):
                c.add_argument(f"--{f}", action="store_true")
            elif f in ("start", "end"):
                c.add_argument(f"--{f}", type=date.fromisoformat)
            else:
                c.add_argument(f"--{f}")

    command("sources")
    command("ingest", "root", "stations", "regions", "years", "start", "end", "threads", "pace", "user", "password", "manifest", "dry-run", positional=("source",))
    command("normalize", "raw", "out", "manifest", "profile", "mask", "start", "end", "overwrite", "dry-run", positional=("source",))
    command("update", "raw", "out", "manifest", "daily", "profile", "end", "dry-run")
    command("validate", "pairs", "ours", "theirs", "logs", "variables", "out")
    command("qaqc", "rows", "out", positional=("source",))
    command("build-hourly", "rows", "out", positional=("source",))
    command("build-daily", "rows", "out", "start", "end", "keep-extra", positional=("source",))
    command("build-station-por", "rows", "out", "start", "end", "min-days", positional=("source",))
    command("inventory", "rows", "out")
    command("crosswalk-index", "rows", "out", "sample-files")
    command("crosswalk-build", "index", "out")
    command("precedence-study", "a", "b", "out", "keys", "variables")
    command("build-fabric", "rows", "crosswalk", "out", "kind", "precedence", "start", "end", "table")
    command("corrections", "obs", "baseline", "variable", "method", "out")
    command("diagnostics", "rows", "by", positional=("report",))
    command("release-build", "root", "version", "channel", "products")
    command("release-validate", "root", "version")
    command("release-promote", "root", "version", "channel")
    command("pending", "manifest", "root", "start", "end", positional=("source",))
    return p


def main(argv: list[str] | None = None, opener=urllib.request.urlopen) -> int:
    a = parser().parse_args(argv)
    if a.command == "sources":
        print("\n".join(registry.list_sources()))
        return 0
    if a.command == "ingest":
        opener = acquire.Pace(float(a.pace), opener) if a.pace else opener
        jobs = jobs_of(a, opener)
        if a.dry_run:
            print("\n".join(f"{u if isinstance(u, str) else u.full_url} {j.to}" for j in jobs for u in j.urls))
            return 0
        done = registry.get_source(a.source).fetch_raw(jobs, opener=opener, **({"threads": int(a.threads)} if a.threads else {}))
        if a.manifest:  # states of downloads stand beside those of keys
            manifest.Manifest(ship(get_session()), a.manifest).update([(f"{a.source}_files", *d) for d in done])
        print(json.dumps(done))
        return int(any(state == "failed" for _, state, _ in done))
    spark = ship(get_session())
    read = spark.read.parquet
    save = lambda df: df.write.mode("overwrite").parquet(a.out) if a.out else df.show(50, False)
    if a.command == "normalize":
        state = manifest.Manifest(spark, a.manifest or f"{a.out}_manifest")
        print(update.normalize_pending(spark, a.source, a.raw, a.out, state, start=a.start, end=a.end, profile=a.profile or "strict", mask=int(a.mask) if a.mask else None, again=a.overwrite, dry_run=a.dry_run))
    elif a.command == "update":
        raw = dict(x.split("=", 1) for x in a.raw.split(","))
        for done in update.update(spark, raw, a.out, a.manifest or f"{a.out}_manifest", days_out=a.daily, profile=a.profile or "permissive", end=a.end, dry_run=a.dry_run):
            print(done)
    elif a.command == "validate":
        logs = spark.read.text(a.logs).select(F.input_file_name().alias("path"), F.monotonically_increasing_id().alias("line_no"), F.col("value").alias("line")) if a.logs else None
        print(json.dumps(validation.run_validation(read(a.pairs), read(a.ours), read(a.theirs), a.out, variables=a.variables.split(","), logs=logs)))
    elif a.command == "qaqc":
        save(rules.apply_pipeline(read(a.rows), rules.default_pipeline(a.source), source=a.source))
    elif a.command == "build-hourly":
        long = readers.to_long(read(a.rows), list(schema.QC_COLUMNS[a.source]))
        none = {c: F.lit(None).cast("string") for c in ("raw_source_uri", "raw_file_hash") if c not in long.columns}
        save(schema.conform_hourly(long.withColumns(none)))
    elif a.command == "build-daily":
        days = daily.aggregate_daily_wide(daily.drop_failed(por.in_dates(read(a.rows), "datetime_utc", a.start, a.end)), source=None if a.source == "all" else a.source)
        save(schema.conform_daily(days, keep_extra=a.keep_extra))
    elif a.command == "build-station-por":
        good, broken = readers.readable_parquet(spark, a.rows, a.source)
        broken.write.mode("overwrite").json(f"{a.out}_unreadable_{a.source}")
        done = por.build_station_por(spark.read.option("basePath", a.rows).parquet(*good), source=a.source, start=a.start, end=a.end, min_por_days=int(a.min_days or 0), already_daily=registry.get_source(a.source).daily)
        por.write_station_por(done.series, a.out)
        por.write_failure_report(done, a.out, a.source)
    elif a.command == "inventory":
        save(por.inventory(read(a.rows)))
    elif a.command == "crosswalk-index":
        save(crosswalk.index_of_day_files(spark, a.rows, sample_files=int(a.sample_files)) if a.sample_files else crosswalk.station_index(read(a.rows)))
    elif a.command == "crosswalk-build":
        save(crosswalk.build_crosswalk(read(a.index)))
    elif a.command == "precedence-study":
        save(diagnostics.precedence_study(read(a.a), read(a.b), keys=a.keys.split(","), variables=a.variables.split(",")))
    elif a.command == "build-fabric":
        kind = a.kind or "daily"
        time = "date" if kind == "daily" else "datetime_utc"
        fabric.write_fabric(fabric.build_fabric(read(a.rows), read(a.crosswalk), precedence=fabric.load_precedence(a.precedence)[kind], time=time, start=a.start, end=a.end), a.out, table=a.table, time=time)
    elif a.command == "corrections":
        save(corrections.monthly_factors(read(a.obs), read(a.baseline), variable=a.variable, keys=["station_key"], method=a.method or "ratio"))
    elif a.command == "diagnostics":
        df = read(a.rows)
        if a.report == "coverage":
            diagnostics.coverage(df, [c for c, k in df.dtypes if k == "double" and c not in ("lat", "lon", "elev_m")]).show(200, False)
        elif a.report == "latency":
            diagnostics.latency(df).show(200, False)
        else:
            diagnostics.qc_rates(df, (a.by or "source").split(",")).show(200, False)
    elif a.command == "release-build":
        print(release.build_release(spark, a.root, a.version, a.channel, dict(x.split("=", 1) for x in a.products.split(","))))
    elif a.command == "release-validate":
        bad = release.validate_release(spark, a.root, a.version)
        print("\n".join(bad) or "valid")
        return int(bool(bad))
    elif a.command == "release-promote":
        release.promote_release(spark, a.root, a.version, a.channel)
    elif a.command == "pending":
        keys = spark.createDataFrame([(a.source, k) for k in registry.discover_keys(a.source, a.root or ".", a.start, a.end)], "source string, key string")
        manifest.pending(keys, manifest.Manifest(spark, a.manifest).log()).show(10_000, False)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
