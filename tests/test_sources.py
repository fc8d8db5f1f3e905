"""Readers on files in the layouts they are made for."""

import datetime as dt
from types import SimpleNamespace

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from foliospark.operators import runs
from foliospark.schemas import PUBLICATION, struct
from foliospark.sources import feed, manifest, results, run_store, tabular
from foliospark.streaming import jobs

FEED = """<?xml version="1.0"?>
<feed xmlns="http://www.w3.org/2005/Atom" xmlns:arxiv="http://arxiv.org/schemas/atom">
<entry><id>http://arxiv.org/abs/2401.1v1</id><title> Two
lines </title><summary>All &amp; more</summary><published>2024-01-05T10:00:00Z</published>
<updated>2024-02-06T10:00:00Z</updated><author><name>A One</name></author><author><name>B Two</name></author>
<category term="cs.CV"/><category term="cs.LG"/><link href="http://x/html" rel="alternate"/>
<link title="pdf" href="http://x/pdf"/><link title="pdf" href="http://x/second"/>
<arxiv:journal_ref>Nature 1</arxiv:journal_ref><arxiv:doi>10.1/x</arxiv:doi></entry>
<entry><id>http://arxiv.org/abs/2401.2</id><title>Plain</title><summary>S</summary>
<published>2023-12-31T10:00:00Z</published><updated>2023-12-31T10:00:00Z</updated><category term="cs.CL"/></entry>
<entry><id>http://arxiv.org/abs/2401.3</id><title>No summary</title>
<published>2023-12-31T10:00:00Z</published><updated>2023-12-31T10:00:00Z</updated></entry>
<entry><id>http://arxiv.org/abs/2401.4</id><title>Bad date</title><summary>S</summary>
<published>soon</published><updated>2023-12-31T10:00:00Z</updated></entry>
</feed>"""


def test_feed(spark, tmp_path):
    (tmp_path / "page.xml").write_text(FEED)
    entries = feed.read_feed(spark, str(tmp_path))
    got = {r["arxiv_id"]: r for r in feed.publications_from_entries(entries).collect()}
    assert set(got) == {"2401.1v1", "2401.2"}
    first, second = got["2401.1v1"], got["2401.2"]
    assert first["title"] == "Two lines" and first["abstract"] == "All & more"
    assert first["authors"] == "A One, B Two" and first["keywords"] == "cs.CV, cs.LG"
    assert first["journal"] == "Nature 1" and first["doi"] == "10.1/x" and first["pdf_url"] == "http://x/pdf"
    assert first["published_date"] == dt.date(2024, 1, 5) and first["year"] == 2024
    assert second["journal"] == "arXiv:2401.2" and second["doi"] == "http://arxiv.org/abs/2401.2"
    assert second["authors"] == "" and second["pdf_url"] is None and second["cited_by"] == 0
    _, rejects = feed.split_entries(entries)
    assert sorted(r["title"] for r in rejects.collect()) == ["Bad date", "No summary"]


def test_stream_ingest_continues_where_it_stopped(spark, tmp_path):
    source, out, mark = (str(tmp_path / d) for d in ("in", "out", "mark"))
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.xml").write_text(FEED)
    jobs.ingest_feed(spark, source, out, mark)
    (tmp_path / "in" / "b.xml").write_text(FEED.replace("2401.", "2501."))
    jobs.ingest_feed(spark, source, out, mark)
    rows = spark.read.schema(PUBLICATION).parquet(out)
    assert sorted(r["arxiv_id"] for r in rows.collect()) == ["2401.1v1", "2401.2", "2501.1v1", "2501.2"]


def test_csv_round_trip(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = [('He said "hi",\nthen left', "N/A", 3), (None, "x, y", None)]
    df = spark.createDataFrame(rows, "a string, b string, n bigint")
    tabular.write_csv(df, path)
    got = tabular.read_csv(spark, path, df.schema).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(
        [('He said "hi",\nthen left', None, 3), (None, "x, y", None)], key=repr
    )


META = """artifact_uri: file:///x
end_time: {end}
experiment_id: '317'
lifecycle_stage: active
run_id: {run}
run_name: {name}
start_time: {start}
status: {status}
tags: []
"""


def write_run(root, run, name, start, end, status, params, metrics):
    base = root / "317" / run
    for part in ("params", "metrics", "tags", "artifacts"):
        (base / part).mkdir(parents=True)
    (base / "meta.yaml").write_text(META.format(run=run, name=name, start=start, end=end, status=status))
    for key, value in params.items():
        (base / "params" / key).write_text(value)
    for key, lines in metrics.items():
        (base / "metrics" / key).write_text("\n".join(lines) + "\n")
    (base / "tags" / "mlflow.runName").write_text(name)
    (base / "artifacts" / "model.bin").write_bytes(b"\x00\x01")


def test_run_store(spark, tmp_path):
    (tmp_path / "317").mkdir()
    (tmp_path / "317" / "meta.yaml").write_text("experiment_id: '317'\nname: papers\nlifecycle_stage: active\n")
    write_run(tmp_path, "aa", "RF_x", 1000, 4972, 3, {"algorithm": "RF"}, {"test_accuracy": ["5 0.2 0", "6 0.25 1"]})
    write_run(tmp_path, "bb", "LR_y", 2000, 2025, 4, {}, {})
    files = run_store.read_files(spark, str(tmp_path))
    table = run_store.runs(files)
    assert {(r["run_id"], r["status"], r["experiment_id"]) for r in table.collect()} == {("aa", 3, "317"), ("bb", 4, "317")}
    assert {r["run_id"]: r["runtime_sec"] for r in run_store.runtime_seconds(table).collect()} == {"aa": 3.972, "bb": 0.025}
    assert [tuple(r) for r in run_store.experiments(files).collect()] == [("317", "papers")]
    wide = runs.assemble_runs(table, run_store.metrics(files), run_store.params(files), run_store.tags(files))
    got = {r["run_id"]: r for r in wide.collect()}
    assert got["aa"]["metric_test_accuracy"] == 0.25 and got["aa"]["param_algorithm"] == "RF"
    assert got["bb"]["metric_test_accuracy"] is None and not [c for c in wide.columns if c.startswith("tag_")]


def test_results(spark, tmp_path):
    (tmp_path / "RF").mkdir()
    (tmp_path / "LR").mkdir()
    (tmp_path / "RF" / "metrics.json").write_text(
        '{\n "cross_validation": {"mean_score": 0.375, "std_score": 0.04, "scores": [0.3, 0.45]},\n'
        ' "test_metrics": {"accuracy": 0.25},\n "model_info": {"algorithm": "RF", "classes": 44}\n}'
    )
    (tmp_path / "LR" / "model_metadata.yaml").write_text("name: 'm'\nnested:\n  a: 1\nversion: 1.0\n")
    files = results.read_files(spark, str(tmp_path))
    row = results.results(files).first()
    assert row["run_name"] == "RF" and row["metric_test_accuracy"] == 0.25 and row["metric_test_roc_auc"] is None
    assert {tuple(r) for r in results.metadata(files).collect()} == {("LR", "name", "m"), ("LR", "version", "1.0")}
    meta = results.metadata(files).where("key = 'name'").selectExpr("run_name", "value as param_name")
    joined = {r["run_name"]: r for r in runs.join_results(results.results(files), meta).collect()}
    assert set(joined) == {"RF", "LR"} and joined["LR"]["metric_test_accuracy"] is None


def test_broken_entries_cost_only_themselves(spark, tmp_path):
    part = "<id>http://x/{0}</id><title>T{0}</title><summary>S</summary><published>2020-01-02T0</published><updated>2021-01-01</updated>"
    whole = "<entry>" + part + "<arxiv:doi>10/{0}</arxiv:doi></entry>"
    texts = [whole.format(1), whole.format(2).replace("</title>", ""), whole.format(3).replace("</entry>", ""),
             whole.format(4), "<entry><id>5</id></entry>", whole.format(6).replace("<entry>", "<entry a='1'>")]
    (tmp_path / "f.xml").write_text("<feed>\n" + "\n".join(texts) + "\n</feed>")
    (tmp_path / "cut.xml").write_text("<feed>" + whole.format(7) + whole.format(8)[:60])
    good, bad = feed.split_entries(feed.read_feed(spark, str(tmp_path)))
    rows = feed.publications_from_entries(good).collect()
    assert {(r["arxiv_id"], r["doi"]) for r in rows} == {(str(i), f"10/{i}") for i in (1, 4, 6, 7)}
    reasons = {r["id"]: r["malformed"] for r in bad.select(feed.rejected_id().alias("id"), (F.col(feed.CORRUPT).isNotNull()).alias("malformed")).collect()}
    assert reasons == {"http://x/2": True, "http://x/3": True, "5": False, "http://x/8": True}


def test_folder_reads_only_changes(spark, tmp_path):
    root = tmp_path / "tree"
    write_run(root, "aa", "A", 1, 2, 3, {}, {})
    write_run(root, "bb", "B", 1, 2, 3, {}, {})
    known = manifest.Folder(spark, str(root), str(tmp_path / "seen"))
    parse = lambda s, paths: run_store.runs(run_store.read_files(s, paths)).select("run_id", "status")
    read = lambda: [sorted(map(tuple, x.collect())) for x in known.read(parse, str(tmp_path / "out"))]
    assert read() == [[("aa", 3), ("bb", 3)], []]
    assert read() == [[], []]
    meta = root / "317" / "bb" / "meta.yaml"
    meta.write_text(meta.read_text().replace("status: 3", "status: 10"))
    (root / "317" / "aa" / "tags" / "mlflow.runName").rename(root / "317" / "aa" / "tags" / "other")
    rows, gone = read()
    assert rows == [("bb", 10)] and len(gone) == 1 and gone[0][0].endswith("aa/tags/mlflow.runName")


def test_stream_timeouts(spark, tmp_path):
    """Timers are moved by signs of life, taken away by an end, and outlive a restart."""
    t0 = dt.datetime(2024, 1, 1)
    at = lambda days: t0 + dt.timedelta(days=days)
    S, A, E = jobs.STARTED, jobs.ALIVE, jobs.ENDED
    parts = [
        [(1, at(0), S), (2, at(0), S), (3, at(0), S), (4, at(0), S), (5, at(1), S), (8, at(0), E), (9, at(1), "odd")],
        [(1, at(5), E), (3, at(8), A), (5, at(9), E), (6, at(9), S)],
        [(4, at(14), E), (3, at(17), A), (6, at(16), A)],
        [(7, at(30), S)],
        [(2, at(31), E), (7, at(39), A), (6, at(31), S)],
    ]
    schema, out = "run_id bigint, ts timestamp, kind string", str(tmp_path / "out")
    for k, rows in enumerate(parts):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        if k in (1, 4):  # two runs over the same checkpoint
            stream = jobs.read_stream(spark, str(tmp_path / "in"), spark.createDataFrame([], schema).schema, max_files=1)
            jobs.watch_timeouts(stream, 24 * 10, out, str(tmp_path / "mark"))
    got = {(r["run_id"], r["deadline"]) for r in spark.read.parquet(out).collect()}
    assert got == {(2, at(10)), (4, at(10)), (3, at(27)), (6, at(26))}


def test_timeouts_take_a_call_and_no_state_requests_per_run():
    """a run's events and its state come together, and its row and state go back together."""
    state = SimpleNamespace(exists=False, hasTimedOut=False, getCurrentWatermarkMs=lambda: 0, kept=None, timer=None)
    state.update, state.setTimeoutTimestamp = (lambda x: setattr(state, "kept", x)), (lambda x: setattr(state, "timer", x))
    events = pd.DataFrame({"ms": [50, 0, 40], "kind": [1, 0, 1]})
    assert list(jobs._watch(100)((7,), iter([events]), state)) == []
    assert state.kept == (0, 150) and state.timer == 150
    state.exists, state.get, state.remove = True, state.kept, lambda: setattr(state, "kept", None)
    (late,) = jobs._watch(100)((7,), iter([pd.DataFrame({"ms": [151], "kind": [2]})]), state)
    assert late.values.tolist() == [[7, 0, 150]] and state.kept is None


def group_state(watermark):
    """A state store of one group; `now` is moved by the test."""
    state = SimpleNamespace(exists=False, hasTimedOut=False, now=watermark, get=None, timer=None)

    def update(kept):
        state.exists, state.get = True, kept

    def remove():
        state.exists, state.get, state.timer = False, None, None

    state.getCurrentWatermarkMs = lambda: state.now
    state.update, state.remove, state.setTimeoutTimestamp = update, remove, lambda x: setattr(state, "timer", x)
    return state


def test_timeouts_of_a_group_are_those_of_its_runs():
    """one call and one state serve all runs of a group, also those without an id, and follow the rule of a run alone."""
    rng = np.random.default_rng(3)
    whole, own, got, want = group_state(0), {}, [], []
    for step in range(12):
        state_time = whole.now = step * 40
        known = rng.random(300) < 0.95
        events = pd.DataFrame(
            {
                "run_id": np.where(known, rng.integers(-5, 40, 300) + (1 << 60), 0), "known": known,
                "ms": state_time + rng.integers(0, 60, 300), "kind": np.where(known, rng.choice(3, 300, p=[0.5, 0.3, 0.2]), 0),
            }
        )
        events = events if step % 4 != 3 else events[:0]
        whole.hasTimedOut = not len(events) and whole.timer is not None and whole.timer < whole.now
        if len(events) or whole.hasTimedOut:
            for late in jobs._watch_group(50)((0,), iter([events[:100], events[100:]]), whole):
                got += [(None if pd.isna(r) else int(r), int(a), int(b)) for r, a, b in late.values.tolist()]
        asked = {None if not k else r: None for r, k in zip(events["run_id"], events["known"])}
        for r in {**own, **asked}:
            state = own.setdefault(r, group_state(0))
            state.now, state.hasTimedOut = state_time, r not in asked
            if r in asked or (state.exists and state.timer < state_time):
                some = events[~events["known"]] if r is None else events[events["known"] & (events["run_id"] == r)]
                for late in jobs._watch(50)((r,), iter([some]), state):
                    want += [(r, a, b) for a, b in late[["started", "deadline"]].values.tolist()]
        open_runs = {r: s.get for r, s in own.items() if s.exists}
        assert (jobs._unpacked(whole.get[0]) if whole.exists else {}) == open_runs
        assert not open_runs or whole.timer == min(d for _, d in open_runs.values())
    assert len(got) == len(want) > 40 and set(got) == set(want) and None in {r for r, *_ in got}


def test_struct_helper_needs_no_session():
    import pyspark.sql.types as T

    assert struct(a=T.LongType()).simpleString() == "struct<a:bigint>"


def test_paths_of_changed_files_stay_with_the_tasks(spark, tmp_path):
    """parse gets a table, and the listing is no plan over files that the driver has listed."""
    root = tmp_path / "a tree"
    write_run(root, "aa", "A", 1, 2, 3, {"k%20": "v é"}, {})
    (root / "_hidden").mkdir()
    (root / "_hidden" / "x").write_text("no")
    now = manifest.listing(spark, str(root))
    assert "binaryFile" not in now._jdf.queryExecution().executedPlan().toString()
    old = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(str(root))
    assert sorted(map(tuple, now.select("path", "size").collect())) == sorted(map(tuple, old.select("path", "length").collect()))
    seen = []

    def parse(s, paths):
        seen.append(paths)
        return run_store.params(run_store.read_files(s, paths))

    rows, _ = manifest.Folder(spark, str(root), str(tmp_path / "seen")).read(parse, str(tmp_path / "out"))
    assert not isinstance(seen[0], list)
    assert [tuple(r) for r in rows.collect()] == [("aa", "k%20", "v é")]
