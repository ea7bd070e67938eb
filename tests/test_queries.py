"""A part of the catalogue against DuckDB, and the entry module without its optional part."""

import importlib
import sys

import duckdb
import pytest

from wayfuse.plans import catalogue

SF = "/root/testdata/sf0.001"
SOME = ("vehicle_comm_stats", "fuse_record_metrics", "asof_nearest", "polygon_first", "bbox_contain", "smooth_savgol", "trajectory_samples", "enu_project", "utm_project", "grid_density_topk", "messages_per_vehicle_describe", "parse_gnss", "discovery_summary", "infer_vehicle_id")
INGEST = ("parse_gnss_aliases", "parse_v2x_aliases", "read_shapes", "read_sampled", "broken_files", "read_line_files", "files_by_mode", "topic_positions", "topic_messages", "topic_demo", "topic_ingest", "rsu_join", "polygon_file", "polygon_contain", "time_delta_describe", "write_read_csv", "write_read_partitioned", "export_fused", "written_report")


def rows(frame):
    columns = sorted(frame.columns)
    show = lambda v: None if v is None or v != v else round(float(v), 5) + 0.0 if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)
    return columns, sorted([[show(v) for v in r] for r in frame[columns].astype(object).values.tolist()], key=repr)


@pytest.mark.parametrize("name", SOME + INGEST)
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for name_of in ("events", "nation"):
        con.execute(f"CREATE VIEW {name_of} AS SELECT * FROM '{SF}/{name_of}.parquet'")
    assert rows(catalogue.QUERIES[name](spark, SF).toPandas()) == rows(con.execute(catalogue.ORACLE[name]).df())


def test_entry_without_text_operators(monkeypatch, spark):
    for name in [n for n in sys.modules if n.startswith("wayfuse.llm") or n in ("corpus_pipeline", "__spark_entry__")]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, "corpus_pipeline", None)
    entry = importlib.import_module("__spark_entry__")
    assert "pipeline" not in entry.queries() and "fuse_topic" in entry.queries()
    assert set(entry.oracle_sql()) <= set(entry.queries())
    monkeypatch.delitem(sys.modules, "__spark_entry__")
