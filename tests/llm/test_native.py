"""Line dedup, quality rules and the Jaccard join against their SQL on edge rows."""

import duckdb
import pytest

from foliospark.llm.jaccard import link_similar
from foliospark.llm.linededup import LineRuns, dedup_lines
from foliospark.llm.quality import rate_quality
from foliospark.llm.queries import LLM
from foliospark.plans.scratch import new_path
from tests.llm import edge
from tests.oracle import connect, differences


@pytest.fixture(scope="module", params=[False, True], ids=["edge rows", "empty"])
def folder(request, spark):
    path = new_path(spark, "edge").removeprefix("file:")
    tables = {"documents": edge.frame, "benchmark": edge.items, "embeddings": edge.vectors}
    for name, frame in tables.items():
        frame(spark, request.param).coalesce(1).write.parquet(f"{path}/{name}.parquet")
    return path


@pytest.mark.parametrize("name", [n for n, q in LLM.items() if q.sql])
def test_edge_rows_equal_sql(spark, folder, name):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for table in ("documents", "benchmark", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet/*.parquet'")
    q = LLM[name]
    assert differences(q.run(spark, folder), con, q.sql) == []


@pytest.mark.parametrize("name", [n for n, q in LLM.items() if q.sql])
def test_query_equals_sql(spark, name):
    folder = "/root/testdata/sf0.001"
    q = LLM[name]
    assert differences(q.run(spark, folder), connect(folder), q.sql) == []


def test_runs_settle_and_compact(spark):
    runs = LineRuns(spark, min_docs=5, fanout=2)
    for batch in range(5):
        counts = [(k, k, n) for k, n in ((1, 2), (2, 1), (3 + batch, 4))]
        runs.add(spark.createDataFrame(counts, "_h1 long, _h2 long, n long"))
    assert len(runs.levels) > 1 and max(map(len, runs.levels)) < 2
    assert sorted(r._h1 for r in runs.common().collect()) == [1, 2]


def test_later_batches_meet_settled_lines(spark, monkeypatch):
    """At the defaults, lines settled by the first batches are taken out of the later ones."""
    met = []
    plain = LineRuns._without_settled

    def watched(self, rows):
        left = plain(self, rows)
        if self.settled:
            met.append(rows.count() - left.count())
        return left

    monkeypatch.setattr(LineRuns, "_without_settled", watched)
    docs = [(i, f"common line\n{edge.prose(i, 5)}") for i in range(300)]
    out = dedup_lines(spark.createDataFrame(docs, "doc_id long, text string"), min_docs=10)
    assert [r.n_dropped for r in out.select("n_dropped").collect()] == [1] * 300
    assert len(met) >= 9 and sum(met) >= 6


def test_kept_text_and_other_columns(spark):
    out = dedup_lines(edge.frame(spark), min_docs=10)
    assert out.count() == len(edge.rows())
    replaced = ["kept_text", "n_lines"]
    assert edge.kept_columns(out.collect(), replaced) == edge.kept_rows(replaced)
    dotted = edge.frame(spark).withColumnRenamed("source", "a.b")
    assert "a.b" in dedup_lines(dotted).columns
    got = {r.doc_id: r for r in out.collect()}
    assert got[13].kept_text == edge.prose(4, 20) and got[13].score == 0.5
    assert got[14].kept_text == edge.prose(5, 20) + "\n\nend" and got[14].n_dropped == 1
    assert got[1].kept_text == "" and [r for r in out.collect() if r.text is None][0].kept_text is None


def test_bad_hosts_lose_good_documents(spark):
    good, bad = edge.prose(9, 50), "too short"
    rows = [(i, bad, "bad.example") for i in range(60)] + [(100, good, "bad.example")]
    rows += [(200 + i, edge.prose(i, 50), f"host{i % 5}") for i in range(60)] + [(300, good, None)]
    out = rate_quality(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    kept = {r.doc_id: r.kept for r in out.collect()}
    assert not kept[100] and kept[300] and all(kept[200 + i] for i in range(60))


def test_groups_of_copies_and_chains(spark):
    words = edge.prose(70, 400).split()
    chain = [" ".join(f"new{j}" if j < 6 * i else w for j, w in enumerate(words)) for i in range(9)]
    rows = list(enumerate(chain)) + [(100 + i, chain[0]) for i in range(50)]
    rows += [(200, edge.prose(71, 400)), (201, "")]
    got = link_similar(spark.createDataFrame(rows, "doc_id long, text string").repartition(7)).collect()
    roots = {r.doc_id: r.component_id for r in got}
    assert all(roots[i] == 0 for i in [*range(9), *range(100, 150)])
    assert roots[200] == 200 and roots[201] == 201
