"""Retention, resumable stages, giant groups, bucketed upserts, expansion documents, streams of attempts, logs as a source."""

import glob
import json
import os
import random
import time

import pytest
from pyspark.sql import functions as F

from leadloom.operators import expansion, html, resolve, runs, stages, upsert
from leadloom.sources import retention, stage_log
from leadloom.sources.bucketed import BucketedTable
from leadloom.streaming import attempts

def at():
    return F.lit("2026-01-01 00:00:00.123456")


RUNS = [("k", "keep"), ("a", "archive-only"), ("p", "archive-then-purge"), ("empty run", "archive-then-purge")]


# Retention ------------------------------------------------------------------------------------------


@pytest.fixture
def keeper(spark, tmp_path):
    raw = spark.range(300).selectExpr("id", "CASE id % 3 WHEN 0 THEN 'k' WHEN 1 THEN 'a' ELSE 'p' END AS run_id", "CASE WHEN id % 5 > 0 THEN id / 7.0 END AS x", "timestamp'2026-01-01 10:00:00.123456' AS at", "array(id, null) AS list")
    raw.write.partitionBy("run_id").parquet(f"{tmp_path}/raw/one")
    raw.where("run_id <> 'a'").selectExpr("id AS n", "run_id").write.partitionBy("run_id").parquet(f"{tmp_path}/raw/two")
    spark.createDataFrame([(r, "completed", 7) for r, _ in RUNS], "run_id string, status string, total int").write.partitionBy("run_id").parquet(f"{tmp_path}/documents")
    return retention.Retention(spark, {c: f"{tmp_path}/raw/{c}" for c in ("one", "two")}, f"{tmp_path}/archive", f"{tmp_path}/manifest", at(), f"{tmp_path}/documents")


def state(keeper, spark):
    """What there is: rows left and archived by collection and run, and the outcome."""
    count = lambda df: {(r.run_id, r["count"]) for r in df.groupBy("run_id").count().collect()}
    left = {c: count(spark.read.schema("run_id string").parquet(p)) for c, p in keeper.collections.items()}
    kept = {c: count(spark.read.schema("run_id string").json(f"{keeper.archive}/{c}")) for c in keeper.collections if os.path.exists(f"{keeper.archive}/{c}")}
    marks = {tuple(r) for r in keeper.outcome(spark.createDataFrame(RUNS, "run_id string, mode string")).collect()}
    return left, kept, marks


WANT = (
    {"one": {("k", 100), ("a", 100)}, "two": {("k", 100)}},
    {"one": {("a", 100), ("p", 100)}, "two": {("p", 100)}},
    {
        *[("k", c, "keep", "kept", None, None, None) for c in ("one", "two")],
        ("a", "one", "archive-only", "archived", 100, 100, None), ("a", "two", "archive-only", "archived", 0, 0, None),
        *[("p", c, "archive-then-purge", "archived_and_purged", 100, 100, 100) for c in ("one", "two")],
        *[("empty run", c, "archive-then-purge", "archived_and_purged", 0, 0, 0) for c in ("one", "two")],
    },
)


@pytest.mark.parametrize("stop", [None, *retention.STEPS])
def test_retention_goes_on_after_any_step(spark, keeper, stop):
    given = spark.createDataFrame(RUNS, "run_id string, mode string")
    keeper.perform(given, stop_after=stop)
    if stop in ("archived", "verified"):
        assert ("p", 100) in state(keeper, spark)[0]["one"], "nothing is purged before it was verified and its step came"
    keeper.perform(given)
    assert state(keeper, spark) == WANT
    keeper.perform(given)
    assert state(keeper, spark) == WANT, "another call finds nothing to do"
    docs = {r.run_id: r for r in spark.read.option("mergeSchema", "true").parquet(keeper.documents).collect()}
    assert set(docs) == {r for r, _ in RUNS} and all(d.status == "completed" and d.total == 7 for d in docs.values())
    assert docs["p"].raw_retention.status == "archived_and_purged" and [c.deleted for c in docs["p"].raw_retention.collections] == [100, 100]


@pytest.mark.parametrize("step", retention.STEPS)
def test_retention_goes_on_after_a_step_that_broke_off(spark, keeper, step, monkeypatch):
    """The step does its work and dies before the manifest tells of it."""
    given = spark.createDataFrame(RUNS, "run_id string, mode string")
    record = retention.Retention._record

    def dies(self, rows, name):
        if name == step:
            raise OSError("killed")
        record(self, rows, name)

    monkeypatch.setattr(retention.Retention, "_record", dies)
    with pytest.raises(OSError):
        keeper.perform(given)
    monkeypatch.setattr(retention.Retention, "_record", record)
    keeper.perform(given)
    assert state(keeper, spark) == WANT


def test_an_archive_that_differs_is_not_purged(spark, keeper):
    given = spark.createDataFrame(RUNS, "run_id string, mode string")
    keeper.perform(given, stop_after="archived")
    spark.createDataFrame([(1, "p")], "n long, run_id string").write.mode("append").partitionBy("run_id").json(f"{keeper.archive}/two")
    with pytest.raises(retention.RetentionError, match="p: archive differs from raw rows of two"):
        keeper.perform(given)
    left, _, marks = state(keeper, spark)
    assert ("p", 100) in left["one"] and {m[0] for m in marks} == {"k", "a", "empty run"}, "other runs have gone on"
    keeper.perform(given)
    assert state(keeper, spark) == WANT


def test_retention_refuses_unknown_modes_and_blank_runs(spark, keeper):
    for rows, error in (([("k", "burn")], "burn"), ([("k", None)], "None"), ([("", "keep")], "run_id")):
        with pytest.raises(ValueError, match=error):
            keeper.perform(spark.createDataFrame(rows, "run_id string, mode string"))


def test_filter_templates(spark):
    template = {"a": {"b": [retention.RUN, {"c": retention.RUN}]}, "d": 1}
    assert retention.resolve_filter(template, "r") == {"a": {"b": ["r", {"c": "r"}]}, "d": 1}
    rows = spark.createDataFrame([(1, ("r", "x")), (2, ("s", "x")), (3, ("r", None)), (4, None)], "id int, meta struct<run:string,kind:string>")
    got = lambda t: [r.id for r in rows.where(retention.matches(t, F.lit("r"))).collect()]
    assert got({"meta": {"run": retention.RUN}}) == [1, 3] and got({"meta": {"run": retention.RUN, "kind": ["x", "y"]}}) == [1] and got({"meta": {"run": []}}) == []


# Stages ------------------------------------------------------------------------------------------------


def graph_of(spark, root, dies=()):
    dead = set(dies)

    def build(key, f):
        def of(inputs):
            if key in dead:
                dead.discard(key)
                raise OSError(f"{key} died")
            return f(inputs)

        return of

    n = lambda x: spark.range(10).withColumn("x", F.col("id") * x)
    return stages.StageGraph(
        spark, str(root),
        [
            stages.Stage("a", build("a", lambda of: n(1))),
            stages.Stage("b", build("b", lambda of: of["a"].withColumn("x", F.col("x") + 1)), ("a",)),
            stages.Stage("c", build("c", lambda of: of["a"].where("x > 3")), ("a",)),
            stages.Stage("d", build("d", lambda of: of["b"].join(of["c"].select("id"), "id")), ("b", "c")),
        ],
    )


@pytest.mark.parametrize("dies", ["a", "b", "c", "d"])
def test_a_killed_run_ends_as_a_whole_one(spark, tmp_path, dies):
    whole = sorted(graph_of(spark, tmp_path / "whole").run("r", F.current_timestamp).collect())
    graph = graph_of(spark, tmp_path / "killed", [dies])
    with pytest.raises(OSError):
        graph.run("r", F.current_timestamp)
    row = stages.checkpoint(graph.checkpoints(), "r", dies).first()
    assert row.status == "failed" and row.meta["error"] == f"{dies} died" and row.completed_at is None and graph.left("r")[0] == dies
    again = graph_of(spark, tmp_path / "killed")
    assert sorted(again.run("r", F.current_timestamp).collect()) == whole
    assert again.ran == ["a", "b", "c", "d"]["abcd".index(dies) :] and again.left("r") == []
    assert stages.checkpoint(again.checkpoints(), "r", dies).first().meta == {"rows": str(again.output(dies, "r").count()), "error": ""}
    assert graph_of(spark, tmp_path / "killed").run("r", F.current_timestamp).count() == len(whole)
    assert stages.checkpoint(again.checkpoints(), "r", "none").count() == 0 and again.left("other") == ["a", "b", "c", "d"]


def test_a_stage_is_stale_once_one_before_it_ran_again(spark, tmp_path):
    graph = graph_of(spark, tmp_path)
    graph.run("r", F.current_timestamp)
    graph._set("r", "c", "completed", F.current_timestamp(), {})
    assert graph.left("r") == ["d"]
    graph._set("r", "a", "failed", F.current_timestamp(), {})
    assert graph.left("r") == ["a", "b", "c", "d"]
    one = spark.createDataFrame([("r",)], "run_id string")
    assert {r.stage_key: r.state for r in stages.stage_states(one, graph.stages, graph.checkpoints()).collect()} == {"a": "ready", "b": "waiting", "c": "waiting", "d": "waiting"}


def test_graphs_without_an_order_are_refused(spark, tmp_path):
    for keys in ([("b", ("a",)), ("a", ())], [("a", ()), ("a", ())]):
        with pytest.raises(ValueError):
            stages.StageGraph(spark, str(tmp_path), [stages.Stage(k, lambda of: None, n) for k, n in keys])


# Resolution ----------------------------------------------------------------------------------------------

NAMES = ["Acme Roofing", "Acme Roof", "Acme Roofing Inc", "Zenith Homes", "Zenith Home Co", "Acme Rooofing Experts", None, ""]


def random_records(rng, n, domains, phones):
    return [
        {
            "ord": o, "raw_company_name": rng.choice(NAMES), "name": None, "phone": rng.choice([None, *phones]), "domain": rng.choice([None, *domains]), "mailing_street": None, "mailing_city": None, "mailing_state": None,
            "mailing_zip": rng.choice([None, "1", "2"]), "lat": rng.choice([None, 35.0, 35.01, 36.0]), "lng": -83.0,
        }
        for o in range(n)
    ]


@pytest.mark.parametrize("seed", range(30))
def test_streamed_entities_are_those_of_the_plain_loop(seed):
    rng = random.Random(seed)
    rows = random_records(rng, 120, ["a.com", "b.com", "c.com"][: rng.randint(1, 3)], ["1" * 10, "2" * 10][: rng.randint(1, 2)])
    if seed % 2:  # few names: fewer vetoes, more merges
        for r in rows:
            r["raw_company_name"] = rng.choice(NAMES[:3])
    for r in rows:
        r["name"] = (r["raw_company_name"] or "").lower() or None
    want = [(e["members"], e["aliases"], e["phone"], e["domain"], e["confidence"], e["why"], e["founding_domain"]) for e in resolve.merge_in_order([dict(r) for r in rows])]
    held, members = resolve.Entities(), {}
    for r in rows:
        members.setdefault(held.add(r)["founder"], []).append(r["ord"])
    got = [(members[e["founder"]], list(e["aliases"]), e["phone"], e["domain"], e["confidence"], e["why"], e["founding_domain"]) for e in held.all]
    assert got == want


def test_a_giant_domain_streams(spark):
    """200,000 records on one domain: half of them each found an entity, as their names conflict."""
    import resource

    n = 200_000
    held, began = resolve.Entities(), time.time()
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    for o in range(n):
        name = "acme roofing" if o < n // 2 else ("zyx plumbing", "acme roofing")[o % 2]
        held.add({"ord": o, "raw_company_name": name, "name": name, "phone": None, "domain": "hot.com", "mailing_zip": None, "lat": None, "lng": None})
    assert len(held.all) == n // 2 + 1 and time.time() - began < 60
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 500_000, "kilobytes"
    rows = spark.range(20_000).selectExpr("id AS ord", "'Acme Roofing' AS raw_company_name", "CAST(NULL AS STRING) AS raw_phone", "'https://www.hot.com' AS raw_website", "'s' AS mailing_street", "'c' AS mailing_city", "'TN' AS mailing_state", "'1' AS mailing_zip", "1D AS lat", "1D AS lng")
    one = resolve.resolve_entities(rows).collect()
    assert len(one) == 1 and one[0].record_ords == list(range(20_000)) and one[0].merge_confidence == 75


# Bucketed upserts -------------------------------------------------------------------------------------------


def files(path):
    return {f: os.path.getmtime(f) for f in glob.glob(f"{path}/slot=*/part-*")}


def test_upserts_rewrite_touched_buckets_only(spark, tmp_path):
    path, schema = str(tmp_path / "t"), "k string, v bigint, first_seen bigint"
    rules = {"first_seen": upsert.prefer_old}
    old = spark.range(2000).selectExpr("CAST(id AS STRING) AS k", "id AS v", "id AS first_seen")
    table = BucketedTable(spark, path, schema, "k", 8)
    table.load(old)
    before = files(path)
    assert len(before) == 8, "a file for each bucket"
    new = spark.createDataFrame([("7", 1, 100, 5), ("7", 2, None, 6), ("new", 3, 300, 7), (None, 4, 1, 1)], "k string, o int, v bigint, first_seen bigint")
    slots = table.upsert(new, "o", rules)
    after = files(path)
    kept = {f for f in before if int(f.split("slot=")[1].split("/")[0]) not in slots}
    assert 1 <= len(slots) <= 2 and kept < set(after) and all(before[f] == after[f] for f in kept) and len(after) == 8
    want = upsert.upsert(old, upsert.fold(new.where("k IS NOT NULL"), ["k"], "o", rules), ["k"], rules)
    assert sorted(table.read().collect()) == sorted(want.collect())
    assert table.upsert(new.where("k IS NULL"), "o", rules) == [] and table.upsert(new, "o", rules) == slots
    again = BucketedTable(spark, path, schema, "k", 8)
    assert sorted(again.read().collect()) == sorted(want.collect())
    plan = again.merged(upsert.fold(new.where("k IS NOT NULL"), ["k"], "o", rules), slots, rules)._jdf.queryExecution().executedPlan().toString()
    old_side = plan[plan.index("SortMergeJoin") :].split("Scan parquet")[0].rpartition("Sort ")[2]
    assert "Exchange" not in old_side and "Exchange hashpartitioning(o_k" not in plan, "only the batch is shuffled"
    table.close()
    again.close()


# Expansion documents ------------------------------------------------------------------------------------------


def documents(spark, payload, wrapped=False):
    row = spark.createDataFrame([(7, "Acme", "Knoxville", None, 3, "ref", wrapped, payload)], "id int, canonical_name string, mailing_city string, mailing_state string, dataset_id int, dataset_run_ref string, wrapped boolean, payload string")
    return [json.loads(r.d) for r in expansion.expansion_documents(row, "run").orderBy("place").select(F.to_json("document").alias("d")).collect()]


def test_absent_keys_take_defaults_and_nulls_stay(spark):
    own = {"parent_run_id": "run", "company_id": 7, "canonical_name": "Acme", "mailing_city": "Knoxville", "mailing_state": None, "dataset_id": 3, "dataset_run_ref": "ref"}
    assert documents(spark, '{"x": [1, {"y": null}]}') == [own | {"x": [1, {"y": None}]}]
    assert documents(spark, '{"mailing_city": null, "company_id": "x"}') == [own | {"mailing_city": None, "company_id": "x"}]
    assert documents(spark, '[{"a": 1}, 2, [{"b": 2}, "x", [{"c": 3}]], null]') == [own | {"a": 1}, own | {"b": 2}]
    assert documents(spark, None) == documents(spark, "5") == documents(spark, "[]") == documents(spark, "no json") == documents(spark, "null") == []
    fallback = {"source": expansion.FALLBACK_SOURCE}
    assert documents(spark, "{}") == [own | fallback | {"payload": {}}]


def test_result_objects_are_looked_through(spark):
    assert [d["n"] for d in documents(spark, '{"items": [{"n": 9}], "results": [{"n": 1}, 3, {"n": 2}], "doc": 5}', True)] == [1, 2]
    assert [d["n"] for d in documents(spark, '{"documents": [], "payload": {"n": 4}}', True)] == [4]
    assert documents(spark, '{"website": "a.com"}', True)[0]["payload"] == {"website": "a.com"}
    assert documents(spark, '{"results": [{"n": 1}]}')[0]["results"] == [{"n": 1}]


def test_raw_expansions_and_their_run(spark, tmp_path):
    found = spark.createDataFrame([(1, "a.com", None), (2, None, ["x"])], "company_id int, website string, sources array<string>")
    rows = expansion.append_documents(expansion.raw_expansions(found, "serp", "r", at()), str(tmp_path / "x"))
    rows = expansion.append_documents(expansion.raw_expansions(found, "serp", "r", at()), str(tmp_path / "x"))
    assert rows.count() == 4 and {json.loads(r.j)["company_id"] for r in rows.select(F.to_json("raw_payload").alias("j")).collect()} == {1, 2}
    run = expansion.expansion_run(rows, "serp", "r", at(), at()).first()
    assert (run.run_id, run.record_count, run.status) == ("company_expansion::r", 4, "completed")
    assert expansion.expansion_run(rows.limit(0), "serp", "r", at(), at()).first().record_count == 0


def test_rows_are_counted_without_digests(spark, tmp_path):
    keeper = retention.Retention(spark, {"x": "x"}, str(tmp_path), str(tmp_path / "m"), F.current_timestamp())
    rows = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "run_id string, v int")
    counted = keeper._counted(lambda name: rows, ["a", "b"], digest=False)
    assert sorted((r.run_id, r.n) for r in counted.collect()) == [("a", 2), ("b", 1)] and "digest" not in counted.columns


# Attempts, logs, lines -------------------------------------------------------------------------------------------


def test_attempts_through_state_equal_the_batch_join(spark, tmp_path):
    rng = random.Random(1)
    rows = [(rng.randrange(40), rng.choice(["ok", "failed", "failed", "failed", None])) for _ in range(150)]
    for k in range(5):
        spark.createDataFrame(rows[k::5], "parcel_id long, status string").coalesce(1).write.mode("append").parquet(f"{tmp_path}/landed")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", attempts.ROCKS)
    try:
        for _ in range(2):  # the second call finds nothing new
            arriving = spark.readStream.schema("parcel_id long, status string").option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/landed")
            attempts.follow(arriving, f"{tmp_path}/verdicts", f"{tmp_path}/checkpoint", 4)
    finally:
        spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
    seeds, verdicts = spark.range(45).withColumnRenamed("id", "parcel_id"), spark.read.parquet(f"{tmp_path}/verdicts")
    want = runs.remaining_seeds(seeds, spark.createDataFrame(rows, "parcel_id long, status string"), 4)
    assert sorted(attempts.seeds_left(seeds, verdicts).collect()) == sorted(want.collect())
    assert {r.verdict for r in verdicts.collect()} == {"open", "done", "given_up"}


def test_attempts_are_counted_without_python_workers(spark, tmp_path):
    spark.createDataFrame([(1, "ok")], "parcel_id long, status string").write.parquet(f"{tmp_path}/landed")
    arriving = spark.readStream.schema("parcel_id long, status string").parquet(f"{tmp_path}/landed")
    plan = attempts.attempt_verdicts(arriving, 4)._jdf.queryExecution().logical().toString()
    assert "Aggregate" in plan and "TransformWithState" not in plan


@pytest.mark.parametrize("split", [7, 64, 1 << 20])
def test_logs_read_in_ranges(spark, tmp_path, split):
    lines = [rng_line for k in range(200) for rng_line in (f"key{k % 7}: value {k} ", "noise", f"é{k}: no", "", f"run_id: r{k}")]
    for name in ("a.log", "b.log"):
        (tmp_path / name).write_text("\n".join(lines) + ("" if name == "a.log" else "\n"))
    (tmp_path / "_SUCCESS").write_text("key: value")
    stage_log.register(spark)
    rows = spark.read.format("stage_log").option("split_bytes", split).load(str(tmp_path))
    want = [(k, v) for k in range(200) for k, v in ((f"key{k % 7}", f"value {k}"), ("run_id", f"r{k}"))]
    got = [(r.key, r.value) for r in rows.orderBy("file", "line_no").collect()]
    assert got == want * 2
    one = rows.where("key = 'key3'")
    assert one.count() == 2 * len([k for k, _ in want if k == "key3"]) and rows.where(F.col("file") == f"{tmp_path}/a.log").count() == len(want)


def test_many_small_logs_share_tasks(spark, tmp_path):
    for k in range(300):
        (tmp_path / f"{k}.log").write_text(f"run_id: r{k}\napplied: {k}\n")
    reader = stage_log.StageLogReader(str(tmp_path), 8)
    tasks = reader.partitions()
    assert len(tasks) < 10 and len({r for t in tasks for r in t.ranges}) == sum(len(t.ranges) for t in tasks) > 600
    assert sum(b.num_rows for t in tasks for b in reader.read(t)) == 600 and len(stage_log.StageLogReader(str(tmp_path), 8, 1).partitions()) > 600


def test_filters_reach_the_log_reader():
    from pyspark.sql.datasource import EqualTo, GreaterThan

    reader = stage_log.StageLogReader("/nowhere", 1)
    rest = list(reader.pushFilters([EqualTo(("key",), "x"), GreaterThan(("line_no",), 3), EqualTo(("key",), "y")]))
    assert reader.wanted == {"key": "x"} and len(rest) == 2


def test_review_lines_equal_review_rows(spark):
    rng = random.Random(2)
    said = ["Acme Plumbing", "Zed", "4.5 (12 reviews)", "1,200 reviews", "12 Main St", "Plumbing", "Roofing", "open now", "", "Insurance", "x", "Best Co"]
    pages = {p: [rng.choice(said) for _ in range(60)] for p in range(8)}
    rows = [(p, k, v) for p, lines in pages.items() for k, v in enumerate(lines)]
    rng.shuffle(rows)
    got = html.review_lines(spark.createDataFrame(rows, "page long, line_no int, line string"), "page", "line_no").orderBy("page", "place").collect()
    want = [(p, k, *b.values()) for p, lines in pages.items() for k, b in enumerate(html.review_rows("\n".join(lines)))]
    assert [tuple(r) for r in got] == want and len(want) > 8
    assert html.review_lines(spark.createDataFrame([], "page long, line_no int, line string"), "page", "line_no").collect() == []


def test_review_pages_of_any_length(spark):
    said = [line for k in range(250) for line in (f"Firm {k % 240}", "4.5 (12 reviews)")]
    lines = spark.createDataFrame([(1, k, v) for k, v in enumerate(said)], "page long, line_no int, line string")
    assert html.review_lines(lines, "page", "line_no").count() == 240 and html.review_lines(lines, "page", "line_no", repeats=True).count() == 250
    assert len(html.review_rows("\n".join(said))) == 100
