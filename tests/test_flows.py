"""Lineage, reconciliation, bounded groups, replication and streams."""

import json
import random
from collections import Counter, deque
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from dictspark.functions.selection import option
from dictspark.operators import lineage as L
from dictspark.operators.components import connected
from dictspark.operators.bounded import part_at, part_by
from dictspark.operators.directory import describe_function
from dictspark.operators.quality import quality_profile
from dictspark.operators.reconcile import differing_columns, except_all, fingerprint, narrow, reconcile, unequal_parts
from dictspark.operators.replication import Replicator, Source, apply_changes, last_modified, preview, read_full, snapshot_diff
from dictspark.operators.versions import latest, prefer_active
from dictspark.functions.types import Field
from dictspark.session import CHECKPOINT_CONF, shared_dir, work_dir
from dictspark.streaming.delta import append_to, change_stream, compact, layer_to, once, read_batches, read_replica, run_delta
from dictspark.streaming.replica import ManifestConflict, Replica


def rows(df):
    return sorted(tuple(r) for r in df.collect())


# --- lineage -----------------------------------------------------------------------------------


def reach(arcs, start, limit=None):
    near = {}
    for a, b in arcs:
        near.setdefault(a, set()).add(b)
    depth, queue = {start: 0}, deque([start])
    while queue:
        node = queue.popleft()
        for other in near.get(node, ()):
            if other not in depth and (limit is None or depth[node] < limit):
                depth[other] = depth[node] + 1
                queue.append(other)
    return sorted(depth.items())


@pytest.mark.parametrize(("seed", "limit"), [(1, None), (2, 2)])
def test_trace_is_breadth_first(spark, seed, limit):
    rng = random.Random(seed)
    arcs = [(f"n{rng.randrange(30)}", f"n{rng.randrange(30)}") for _ in range(45)] + [("n0", f"leaf{i}") for i in range(100)]
    frame = spark.createDataFrame(arcs, "src string, tgt string")
    start = spark.createDataFrame([("n0",)], "node string")
    assert rows(L.trace(frame, start, "down", limit)) == reach(arcs, "n0", limit)
    assert rows(L.trace(frame, start, "up", limit)) == reach([(b, a) for a, b in arcs], "n0", limit)


def test_trace_follows_hubs_and_moves_no_arcs(spark):
    rng = random.Random(5)
    arcs = [("n0", f"m{i}") for i in range(400)] + [(f"m{rng.randrange(400)}", f"x{i}") for i in range(300)] + [(f"x{i}", "n0") for i in range(0, 300, 7)] + [(None, "x1"), ("x2", None)]
    frame = spark.createDataFrame(arcs, "src string, tgt string")
    start = spark.createDataFrame([("n0",), ("n0",)], "node string")
    assert rows(L.trace(frame, start, buckets=3, hub_arcs=50)) == reach([a for a in arcs if None not in a], "n0", None)
    assert L.trace(frame, start.limit(0)).collect() == [] and rows(L.trace(frame.limit(0), start)) == [("n0", 0)]
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("dictspark_")]
    # the plan of a round: neither arcs nor seen nodes are shuffled, also where nothing is broadcast
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    for hubs, by in ((None, ["near"]), (spark.createDataFrame([("n0", 3)], "near string, parts int"), ["near", "part"])):
        stored, seen = L._Bucketed(spark, 4, by), L._Bucketed(spark, 4, ["node"], ["depth"])
        stored.append(frame.selectExpr("src AS near", "tgt AS far", "pmod(hash(tgt), 3) AS part").select("far", *by).repartition(4, *by))
        seen.append(start.distinct().withColumn("depth", F.lit(0)).repartition(4, "node"))
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
        reached = L._reached(stored.read(), seen.read().where("depth = 0"), hubs, 4)
        round_ = L._unseen(reached, seen.read(), 1, 4)
        plan = round_._jdf.queryExecution().executedPlan().toString()
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
        moved = [line for line in plan.splitlines() if "Exchange" in line]
        # the reached nodes alone; with hubs the frontier, too, which also meets them by a join
        assert len(moved) <= (1 if hubs is None else 4) and plan.count("Bucketed: true") >= 2, plan
        stored.forget()
        seen.forget()


def plain_components(edges):
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        if a is not None and b is not None:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return sorted((x, find(x)) for x in root)


@pytest.mark.parametrize("seed", [0, 1])
def test_connected_components(spark, seed):
    rng = random.Random(seed)
    path = [f"p{i:04d}" for i in range(300)]
    mixed = rng.sample(path, len(path)) if seed else path  # a long path, in order and not
    edges = list(zip(mixed, mixed[1:])) + [("hub", f"leaf{i}") for i in range(200)] + [(f"r{rng.randrange(150)}", f"r{rng.randrange(150)}") for _ in range(90)]
    edges += [("loop", "loop"), ("hub", "hub"), ("hub", "leaf3"), ("leaf3", "hub"), (None, "x"), ("y", None), (None, None)]
    frame = spark.createDataFrame(edges, "src string, tgt string")
    assert sorted(map(tuple, connected(frame).collect())) == plain_components(edges)
    assert connected(frame.limit(0)).collect() == []


def test_graph_documents_hold_every_edge_once(spark):
    hub = spark.range(1000).selectExpr("'HUB' AS a", "concat('t', id) AS b", "'S' AS scope")
    small = spark.range(3).selectExpr("concat('s', id) AS a", "'T' AS b", "'Z' AS scope")
    apart = spark.range(5).selectExpr("concat('u', id) AS a", "concat('v', id) AS b", "CAST(NULL AS STRING) AS scope")
    edges = L.edges_of(hub.unionByName(small).unionByName(apart).unionByName(apart), "DATA", ("K", F.col("a")), ("K", F.col("b")), keep=["scope"])
    documents = L.graph_json(edges, ["scope"], edges_per_document=100).collect()
    assert {(d.scope, d.component, d.part) for d in documents if d.scope == "S"} == {("S", "K:HUB", i) for i in range(10)}
    assert sorted((d.scope, d.component, d.part) for d in documents if d.scope == "Z") == [("Z", "K:T", 0)]
    assert sorted(d.component for d in documents if d.scope is None) == [f"K:u{i}" for i in range(5)]
    assert len(L.graph_json(edges, ["scope"]).collect()) == 7
    parsed = [json.loads(d.json) for d in documents]
    assert len({(e["src"], e["tgt"]) for p in parsed for e in p["edges"]}) == sum(len(p["edges"]) for p in parsed) == 1008
    assert max(len(p["edges"]) for p in parsed) < 200
    assert all({f"{n['kind']}:{n['name']}" for n in p["nodes"]} == {e[x] for e in p["edges"] for x in ("src", "tgt")} for p in parsed)


def test_edges_scope_and_level(spark):
    df = spark.createDataFrame([("a", "b")], "x string, y string")
    mappings = [L.edges_of(df, "D", ("K", F.col("x")), ("K", F.col("y"))), L.edges_of(df, "F", ("K", F.col("x")), ("K", F.col("y")), ("f", "g"))]
    edges = L.lineage_edges([*mappings, mappings[0]])
    assert tuple(edges.columns) == L.EDGE_COLUMNS and edges.count() == 2
    assert rows(L.pairs(edges)) == [("K:a", "K:b")] and rows(L.pairs(edges, "field")) == [("K:a.f", "K:b.g")]
    assert L.lineage_edges(mappings, scope="z*").count() == 0
    elements = spark.createDataFrame([("K:b.g",)], "node string")
    assert rows(L.query_lineage(elements, edges)) == [("K:a.f", 1)]


def test_trace_computes_arcs_once(spark):
    counted = spark.sparkContext.accumulator(0)

    def seen(rows):
        for row in rows:
            counted.add(1)
            yield row

    arcs = spark.createDataFrame(spark.createDataFrame([("a", "b"), ("b", "c"), ("b", "d"), ("b", "e")], "src string, tgt string").rdd.mapPartitions(seen), "src string, tgt string")
    assert rows(L.trace(arcs, spark.createDataFrame([("a",)], "node string"), buckets=2, hub_arcs=2)) == [("a", 0), ("b", 1), ("c", 2), ("d", 2), ("e", 2)]
    assert counted.value == 4


def test_hubs_are_found_among_full_slots(spark, monkeypatch):
    arcs = spark.createDataFrame([("a", str(i)) for i in range(7)] + [("b", "x"), ("c", "x")], "near string, far string")
    assert rows(L._hubs(arcs, 3)) == [("a", 3)]
    assert L._hubs(arcs, 7) is None
    monkeypatch.setattr(L, "HUB_SLOTS", 1)
    assert rows(L._hubs(arcs, 3)) == [("a", 3)]
    assert L._hubs(arcs, 8) is None


# --- bounded groups ----------------------------------------------------------------------------


def test_parts_depend_on_the_row_alone(spark):
    df = spark.range(3000).select("id", part_at(F.col("id"), 100).alias("part"), part_by([F.col("id")], 20).alias("dealt"))
    sizes = df.groupBy("part").agg(F.count("id").alias("n"), F.min("id").alias("first"))
    assert rows(sizes) == [(i, 100, 100 * i) for i in range(30)]
    dealt = [r["count"] for r in df.groupBy("dealt").count().collect()]
    assert len(dealt) == 20 and max(dealt) < 250
    assert rows(df.where("id % 7 = 3")) == [r for r in rows(df) if r[0] % 7 == 3]
    assert spark.range(1).select(part_at(F.lit(None).cast("int"))).first()[0] == 0
    with pytest.raises(ValueError):
        part_by([F.lit(1)], 0)


def test_describe_function_loses_nothing(spark):
    parameters = spark.createDataFrame(
        [("F", "import", f"P{i}", "t", "DEC", 9, 2, None, False, i, "") for i in range(5)],
        "function string, direction string, name string, text string, type string, length int, decimals int, default string, optional boolean, pos int, ref string",
    )
    headers = spark.createDataFrame([("F", "F", "text", "grp", True), ("G", "G", "no parameters", "grp", False)], "function string, name string, text string, group string, remote boolean")
    sources = spark.createDataFrame([("F", i, f"line {i}") for i in range(25)], "function string, line_no int, line string")
    out = {(r.function, r.part): r for r in describe_function(parameters, headers, sources, size=10).collect()}
    assert sorted(out) == [("F", 0), ("F", 1), ("F", 2), ("G", 0)]
    assert "\n".join(out["F", i].source for i in range(3)) == "\n".join(f"line {i}" for i in range(25))
    assert [(p.name, p.sql_type, p.direction) for p in out["F", 0]["import"]] == [(f"P{i}", "DECIMAL(9,2)", "import") for i in range(5)]
    assert (out["F", 0].group, out["F", 0].remote, out["G", 0].text, out["G", 0].source) == ("grp", True, "no parameters", None)
    assert [r.function for r in describe_function(parameters).collect()] == ["F"]


def test_pick_one_per_key(spark):
    df = spark.createDataFrame([("x", "D", 1), ("x", "A", 2), ("y", "D", 3)], "k string, version string, n int")
    assert rows(prefer_active(df, ["k"])) == [("x", "A", 2), ("y", "D", 3)]
    assert rows(latest(df, ["k"], ["n"])) == [("x", "A", 2), ("y", "D", 3)]


# --- reconciliation ----------------------------------------------------------------------------

A = [(1, "a", None), (2, "b", 1.0), (2, "b", 1.0), (3, "c", 1.0), (4, "d", 1.0)]
B = [(1, "a", None), (2, "b", 1.0), (3, "x", 2.0), (5, "e", None)]
ROW = "k int, s string, v double"


def test_reconcile(spark):
    a, b = spark.createDataFrame(A, ROW), spark.createDataFrame(B, ROW)
    assert rows(reconcile(a, b, ["k"])) == [(3, 2, 1, 1)]
    assert rows(reconcile(a, a, ["k"])) == [(0, 0, 0, 1)]
    assert rows(differing_columns(a, b, ["k"])) == [(3, "s,v")]
    out = except_all(a, b)
    assert rows(out.where("side = 'extra'").select("k", "n")) == [(2, 1), (3, 1), (4, 1)]
    assert rows(out.where("side = 'missing'").select("k", "n")) == [(3, 1), (5, 1)]
    with pytest.raises(ValueError):
        reconcile(a, b.drop("v"), ["k"])


@pytest.mark.parametrize("algorithm", ["xxhash64", "md5"])
def test_fingerprint_ignores_order_and_partitions(spark, algorithm):
    df = spark.range(500).selectExpr("id % 3 AS g", "id", "IF(id % 5 = 0, NULL, concat('v', id)) AS v")
    first = rows(fingerprint(df, algorithm=algorithm))
    assert first == rows(fingerprint(df.orderBy(F.desc("id")).repartition(7), algorithm=algorithm))
    assert first != rows(fingerprint(df.where("id <> 3"), algorithm=algorithm))
    assert first != rows(fingerprint(df.withColumn("v", F.coalesce("v", F.lit(""))), algorithm=algorithm))
    assert sum(r[1] for r in rows(fingerprint(df, by=["g"], algorithm=algorithm))) == 500


def test_quality(spark):
    cells = spark.createDataFrame([("20240101",), ("00000000",), ("",), ("20230230",), ("99991231",), (None,)], "d string")
    assert rows(quality_profile(cells, [Field("d", "DATS", 8)])) == [("d", 5, 1, 1, 1, 1)]


# --- replication -------------------------------------------------------------------------------


def test_change_modes(spark):
    old, new = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "k int, v string"), spark.createDataFrame([(1, "a"), (2, "x"), (4, "n")], "k int, v string")
    assert rows(snapshot_diff(old, new, ["k"])) == [(2, "x", "U"), (4, "n", "U")]
    everything = snapshot_diff(old, new, ["k"], emit_deletes=True)
    assert rows(apply_changes(old, everything, ["k"])) == rows(new)
    assert rows(apply_changes(old, snapshot_diff(old, new, ["k"]), ["k"]).select("k")) == [(1,), (2,), (3,), (4,)]
    log = spark.createDataFrame([(2, "first", 1, "U"), (2, "last", 2, "U"), (1, None, 3, "D")], "k int, v string, seq int, change_mode string")
    assert rows(apply_changes(old, log, ["k"], order=["seq"])) == [(2, "last"), (3, None)]


CHANGES = "id int, kind string, ts timestamp_ntz"


def log_until(spark, hour):
    return spark.sql(f"SELECT CAST(id AS INT) AS id, IF(id % 2 = 0, 'even', 'odd') AS kind, TIMESTAMP_NTZ '2024-01-01' + make_interval(0,0,0,0,CAST(id AS INT)) AS ts FROM range({hour})")


def source(spark, hour):
    return Source("BW", "LOG$F", log_until(spark, hour), ("id",), "ts")


@pytest.fixture
def subscriber(spark):
    return Replicator(spark, work_dir(spark, "registry"))


def test_delta_life(spark, subscriber):
    assert subscriber.read_delta(source(spark, 5), "P").count() == 5
    second = subscriber.read_delta(source(spark, 8), "P", ["id"], [option("kind", "even")])
    assert rows(second) == [(4,), (6,)]  # the stamp of the pointer is delivered again
    assert subscriber.read_delta(source(spark, 8), "Q").count() == 8
    recovered = subscriber.read_delta(source(spark, 8), "P", recover=True)
    assert rows(recovered) == rows(second) == rows(subscriber.read_delta(source(spark, 12), "P", recover=True))
    with pytest.raises(ValueError, match="original"):
        subscriber.read_delta(source(spark, 8), "P", ["id"], recover=True)
    assert rows(subscriber.read_delta(source(spark, 8), "P", ["id"], change_mode=True)) == [(7, "U")]
    assert rows(subscriber.read_delta(source(spark, 3), "P", ["id"])) == []  # the newest rows are gone; the pointer stays
    assert subscriber.close_cursor("BW", "P", "LOG$F") == "CLOSED" == subscriber.close_cursor("BW", "P", "LOG$F")
    assert subscriber.close_cursor("BW", "NOPE", "LOG$F") == "NOT_FOUND"
    assert {r.subscriber_proc: r.status for r in subscriber.cursors().collect()} == {"P": "CLOSED", "Q": "OPEN"}
    assert rows(subscriber.read_delta(source(spark, 10), "P").select("id")) == [(7,), (8,), (9,)]
    assert subscriber.drop("BW", "P", "LOG$F") and not subscriber.drop("BW", "P", "LOG$F")
    assert [r.subscriber_process for r in subscriber.subscriptions("BW", "LOG$F").collect()] == ["Q"]
    assert subscriber.subscriptions(process="NOPE").count() == 0
    with pytest.raises(ValueError, match="nothing to recover"):
        subscriber.read_delta(source(spark, 10), "P", recover=True)
    assert subscriber.read_delta(source(spark, 10), "P").count() == 10


def test_delta_of_rows_without_stamp_and_late_ties(spark, subscriber):
    first = spark.sql("SELECT * FROM VALUES (1, TIMESTAMP_NTZ '2024-01-01'), (2, CAST(NULL AS TIMESTAMP_NTZ)) AS t(id, ts)")
    late = first.unionByName(spark.sql("SELECT 3 AS id, TIMESTAMP_NTZ '2024-01-01' AS ts"))
    read = lambda df: sorted(r.id for r in subscriber.read_delta(Source("BW", "TIES", df, ("id",), "ts"), "P").collect())
    assert read(first) == [1, 2]
    assert read(late) == [1, 3]


def test_repeated_keys_are_an_error(spark):
    old, new = spark.createDataFrame([(1, "a"), (1, "b")], "k int, v string"), spark.createDataFrame([(1, "a")], "k int, v string")
    with pytest.raises(Exception, match="repeats the key"):
        snapshot_diff(old, new, ["k"]).collect()


def test_delta_needs_a_change_column(spark, subscriber):
    plain = Source("BW", "PLAIN", log_until(spark, 3), ("id",))
    with pytest.raises(ValueError, match="does not support deltas"):
        subscriber.read_delta(plain, "P")
    with pytest.raises(ValueError, match="does not track"):
        last_modified(plain)


def test_empty_source(spark, subscriber):
    assert subscriber.read_delta(source(spark, 0), "P").count() == 0
    assert subscriber.read_delta(source(spark, 2), "P").count() == 2


def test_reads(spark):
    assert str(last_modified(source(spark, 3)).first().last_modified) == "20240101020000.0000000"
    assert rows(read_full(source(spark, 9), ["id"], [option("id", "3", "4")], threads=2)) == [(3,), (4,)]
    assert rows(preview(source(spark, 9), 2, ["id"])) == [(0,), (1,)]


def test_narrowed_tables_hold_the_changes(spark):
    old = spark.range(4000).selectExpr("id AS k", "IF(id % 3 = 0, NULL, id) AS v", "IF(id % 3 = 0, id, NULL) AS w")
    old = old.unionByName(spark.createDataFrame([(None, 1, None), (None, 1, None)], "k long, v long, w long"))
    swap = "k = 7"
    new = old.where("k IS NULL OR k <> 30").selectExpr("k", f"IF({swap}, w, v) AS v", f"IF({swap}, v, w) AS w").unionByName(spark.createDataFrame([(9000, 1, 1), (12, None, 12)], "k long, v long, w long"))
    small = narrow(old, new, ["k"], 500)
    # 7 with its cells in each other's place, 30 gone, 9000 new, 12 now twice
    assert unequal_parts(old, new, ["k"], 500).count() == 4 and 0 < small[0].count() < 100
    assert set(except_all(*small).collect()) == set(except_all(old, new).collect())
    assert rows(differing_columns(*small, ["k"])) == rows(differing_columns(old, new, ["k"])) == [(7, "v,w")]
    assert [df.count() for df in narrow(old, old.repartition(3), ["k"])] == [0, 0]
    assert [df.count() for df in narrow(old.limit(0), old, ["k"], 1)] == [0, old.count()]
    with pytest.raises(ValueError):
        unequal_parts(old, new, ["k"], 0)


# --- streams -----------------------------------------------------------------------------------


def test_stream_increments_add_up(spark):
    feed, out, checkpoint = (work_dir(spark, n) for n in ("feed", "out", "checkpoint"))
    schema = log_until(spark, 1).schema
    log_until(spark, 5).write.parquet(feed)
    run_delta(change_stream(spark, feed, schema), checkpoint, append_to(out))
    run_delta(change_stream(spark, feed, schema), checkpoint, append_to(out))
    assert read_batches(spark, out, schema).count() == 5
    log_until(spark, 9).where("id >= 5").write.mode("append").parquet(feed)
    run_delta(change_stream(spark, feed, schema), checkpoint, append_to(out))
    delivered = read_batches(spark, out, schema)
    assert rows(delivered.select(*schema.names)) == rows(log_until(spark, 9))
    assert rows(delivered.groupBy("batch_id").count()) == [(0, 5), (1, 4)]


def test_failed_batch_is_delivered_again_once(spark):
    feed, out, checkpoint = (work_dir(spark, n) for n in ("feed", "out", "checkpoint"))
    schema = log_until(spark, 1).schema
    log_until(spark, 5).write.parquet(feed)
    write, seen = append_to(out), []

    def fails_after_writing(batch, batch_id):
        write(batch, batch_id)
        seen.append(batch_id)
        if len(seen) == 1:
            raise RuntimeError("lost")

    with pytest.raises(Exception, match="lost"):
        run_delta(change_stream(spark, feed, schema), checkpoint, fails_after_writing)
    run_delta(change_stream(spark, feed, schema), checkpoint, fails_after_writing)
    assert seen == [0, 0]
    assert rows(read_batches(spark, out, schema).select("id")) == [(i,) for i in range(5)]


def test_replica_of_layers(spark):
    feed, out, checkpoint = (work_dir(spark, n) for n in ("feed", "out", "checkpoint"))
    first = spark.createDataFrame([(1, "a", 1, "U"), (1, "b", 2, "U"), (2, "c", 1, "U")], "k int, v string, seq int, change_mode string")
    second = spark.createDataFrame([(1, None, 3, "D"), (3, "n", 1, "U")], first.schema)
    for part in (first, second):
        part.coalesce(1).write.mode("append").parquet(feed)
        run_delta(change_stream(spark, feed, first.schema), checkpoint, layer_to(out, ["k"], ["seq"]))
    replica = read_replica(spark, out, first.schema, ["k"], ["seq"])
    assert rows(replica.select("k", "v")) == [(2, "c"), (3, "n")]
    assert rows(compact(spark, out, work_dir(spark, "compact"), first.schema, ["k"], ["seq"])) == rows(replica)


@pytest.mark.parametrize("lateness", [None, "10 days"])
def test_images_are_delivered_once(spark, lateness):
    feed, out, checkpoint = (work_dir(spark, n) for n in ("feed", "out", "checkpoint"))
    schema = "id int, ts timestamp_ntz, v string"
    day = lambda n: datetime(2024, 1, n)
    first = [(1, day(1), "a"), (2, day(5), "b"), (3, None, "x"), (2, day(5), "b")]
    second = [(2, day(5), "b"), (4, day(5), None), (2, day(5), "changed"), (3, None, "x"), (3, None, None), (5, day(6), "e")]
    writes, faults = append_to(out), []

    def fails_once(batch, batch_id):
        writes(batch, batch_id)
        if faults:
            raise RuntimeError(faults.pop())

    for i, part in enumerate((first, second, second)):
        written = spark.createDataFrame(part, schema)
        written.coalesce(1).write.mode("append").parquet(feed)
        stream = once(change_stream(spark, feed, written.schema), "ts", lateness)
        if i == 1:
            faults.append("lost")
            with pytest.raises(Exception, match="lost"):
                run_delta(stream, checkpoint, fails_once)
        run_delta(stream, checkpoint, fails_once)
    delivered = read_batches(spark, out, written.schema).select("id", "ts", "v").collect()
    assert Counter(tuple(r) for r in delivered) == Counter(set(first + second))


def opened(df):
    return {path.rsplit("/", 2)[-2] for path in df.inputFiles()}


def test_replica_of_levels(spark):
    schema = "k int, v string, seq int, change_mode string"
    batches = [
        [(1, "a", 1, "U"), (1, "b", 2, "U"), (2, "c", 5, "U"), (None, "n", 1, "U")],
        [(1, None, 3, "D"), (3, "n", 1, "U")],
        [(1, "late", 2, "U"), (2, "same", 5, "U")],
        [],
        [(4, "x", None, "U"), (None, "m", 2, "U")],
        [(3, None, 9, "D"), (4, "y", 0, "U")],
    ]
    empty = spark.createDataFrame([], schema)
    replica = Replica(spark, work_dir(spark, "replica"), empty.schema, ("k",), ("seq",), fanout=2)
    assert replica.read().count() == 0 and replica.unused() == []
    deliver = replica.layer_to()
    for number, batch in enumerate(batches):
        deliver(spark.createDataFrame(batch, schema), number)
        deliver(spark.createDataFrame(batch, schema), number)
    wanted = {(2, "same"), (4, "y"), (None, "m")}
    before = replica.read()
    assert {tuple(r) for r in before.select("k", "v").collect()} == wanted
    assert sorted(layer["level"] for layer in replica.manifest()["layers"]) == [1, 2]
    assert len(opened(before)) == 2 and replica.manifest()["delivered"] == {"stream": 5}
    replica.compact()
    after = replica.read()
    assert len(opened(after)) == 1 and not opened(after) & opened(before)
    assert {tuple(r) for r in after.select("k", "v").collect()} == wanted
    assert {tuple(r) for r in before.select("k", "v").collect()} == wanted
    # a tombstone outlives merges; images from before it do not come back
    replica.layer_to("other")(spark.createDataFrame([(3, "old", 8, "U"), (5, "z", 1, "U")], schema), 0)
    assert {tuple(r) for r in replica.read().select("k", "v").collect()} == wanted | {(5, "z")}
    replica.compact(forget_deleted=True)
    stored = spark.read.parquet(f"{replica.path}/{replica.manifest()['layers'][0]['folder']}")
    assert stored.where("change_mode = 'D'").count() == 0 and stored.count() == 4


def test_replica_refuses_a_second_writer(spark):
    schema = spark.createDataFrame([(1, 1)], "k int, seq int").schema
    replica = Replica(spark, work_dir(spark, "replica"), schema, ("k",), ("seq",))
    old = replica.manifest()
    replica._publish(old, [], {})
    with pytest.raises(ManifestConflict):
        replica._publish(old, [], {})
    assert replica.manifest()["version"] == 1
    with pytest.raises(ValueError):
        Replica(spark, replica.path, schema, ("k",), ("seq",), fanout=1)


def test_shared_folder_comes_from_the_session(spark):
    folder = spark.conf.get(CHECKPOINT_CONF, None)
    assert folder is None or shared_dir(spark) == folder
    assert spark.sparkContext.getCheckpointDir() is not None
