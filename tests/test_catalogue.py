"""Every query of the core catalogue against its SQL, on the smallest tables."""

import math

import pytest

from stagelight import catalogue, chain, growing, kept, stored, upkeep  # noqa: F401 (these add their queries)

FOLDER = "/root/testdata/sf0.001"


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    return value.isoformat() if hasattr(value, "isoformat") else value


@pytest.mark.parametrize("name", sorted(catalogue.ORACLE_SQL))
def test_query_matches_sql(spark, duck, name):
    df = catalogue.QUERIES[name](spark, FOLDER)
    columns = sorted(df.columns)
    ours = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=repr)
    answer = duck.execute(catalogue.ORACLE_SQL[name])
    names = [x[0] for x in answer.description]
    assert sorted(names) == columns
    at = [names.index(c) for c in columns]
    assert ours == sorted((tuple(plain(r[i]) for i in at) for r in answer.fetchall()), key=repr)


def test_whole_texts_are_judged(spark):
    """What stands after the first 30 or 20 characters counts."""
    larger = "/root/testdata/sf0.01"  # the smallest has no line whose only capitals come late
    docs = spark.read.parquet(f"{larger}/documents.parquet").collect()
    got = {(r["doc_id"], r["pos"]): r["band"] for r in catalogue.QUERIES["band_paragraphs"](spark, larger).collect()}
    assert len(got) == sum(r["text"].count("\n") + 1 for r in docs if r["text"] is not None)
    late = [(r["doc_id"], i) for r in docs if r["doc_id"] % 4 > 1 for i, x in enumerate((r["text"] or "").split("\n")) if any(c.isupper() for c in x[30:]) and not any(c.isupper() for c in x[:30]) and "OPEN 4PM" not in x and "HOSTED BY" not in x]
    assert late and all(got[k] for k in late)
    said = {r["text"] for r in spark.read.parquet(f"{FOLDER}/conversations.parquet").where("role = 'user'").collect()}
    assert {r["carried"] for r in catalogue.QUERIES["carry_forward_header"](spark, FOLDER).collect()} - {None} == said - {None}


def test_entry_points():
    import __spark_entry__ as e

    assert set(catalogue.QUERIES) <= set(e.queries())
    assert set(e.oracle_sql()) <= set(e.queries())


def test_entry_runs(spark):
    import __spark_entry__ as e

    assert e.entry(spark).columns == ["id", "title", "event_day", "venue_id"]


def test_entry_points_import_without_a_session():
    """Queries and their SQL are listed before any session is there."""
    import subprocess
    import sys
    from pathlib import Path

    root = Path(__file__).resolve().parent.parent
    code = "import __spark_entry__ as e; assert len(e.queries()) > 100 and len(e.oracle_sql()) > 100"
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True)
