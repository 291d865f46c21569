"""The whole run: files -> bronze -> silver -> gold. The call graph is the run order."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from jobtide.plans import gold, silver
from jobtide.schemas import CSV_TABLES, JSON_TABLES
from jobtide.sources.store import TABLES, TableStore
from jobtide.streaming.ingest import load_table

Options = Mapping[str, Mapping[str, object]]


def load_bronze(store: TableStore, base: str, **options) -> dict[str, DataFrame]:
    """All files of ``base`` into new bronze tables, which replace the old ones when all are complete.

    ``options`` as in ``ingest.load_table``, whose loads of later files continue this one.
    """
    tables = (*CSV_TABLES, *JSON_TABLES)
    with store.building("bronze"):
        for table in tables:
            load_table(store, base, table, full=True, **options)
    return {table: store.read("bronze", table) for table in tables}


def build_silver(store: TableStore, options: Options | None = None) -> dict[str, DataFrame]:
    """Rebuild the eight silver tables from bronze; they become current together.

    ``options`` maps a table to the options of its function in ``silver``, for example
    ``{"job_postings": {"on_bad_epoch": "null"}, "companies": {"on_bad": "null"}}``.
    """
    options = options or {}
    unknown = set(options) - set(TABLES["silver"])
    if unknown:
        raise ValueError(f"no silver tables: {sorted(unknown)}")
    bronze, built = store.read_layer("bronze"), {}
    with store.building("silver"):
        for table in TABLES["silver"]:
            plan = getattr(silver, table)(bronze[table], **options.get(table, {}))
            built[table] = store.rebuild("silver", table, plan)
    return built


def build_gold(store: TableStore, buckets: int | None = None) -> dict[str, DataFrame]:
    """Rebuild the five gold tables from silver; they become current together.

    With ``buckets``, the tables keyed by job are bucketed by it, and the join of postings and
    industries below reads both sides without a shuffle. ``job_analytics`` is sorted by industry, so
    that panels read the files and row groups of their codes only.
    """
    clean = store.read_layer("silver")

    def keyed(table, df):
        return store.rebuild("gold", table, df, bucket_by="job_id", buckets=buckets)

    with store.building("gold"):
        built = {
            "job_postings": keyed("job_postings", gold.job_postings(clean["job_postings"])),
            "job_industries": keyed("job_industries", gold.job_industries(clean["job_industries"])),
            "job_skills": keyed("job_skills", gold.job_skills(clean["job_skills"])),
            "company_profile": store.rebuild(
                "gold",
                "company_profile",
                gold.company_profile(clean["companies"], clean["employee_counts"]),
            ),
        }
        analytics = gold.job_analytics(
            built["job_postings"], built["job_industries"], built["company_profile"]
        )
        built["job_analytics"] = store.rebuild("gold", "job_analytics", gold.by_industry(analytics))
    return built


def run(
    store: TableStore,
    base: str,
    buckets: int | None = None,
    silver_options: Options | None = None,
    **load_options,
) -> dict[str, DataFrame]:
    """Files to gold; returns the gold tables."""
    store.create_namespaces()
    load_bronze(store, base, **load_options)
    build_silver(store, silver_options)
    return build_gold(store, buckets)
