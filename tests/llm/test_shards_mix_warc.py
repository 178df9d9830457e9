"""Sharding, mixing, WARC audit, and the pipeline."""

import collections
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from sensorloom.llm import cube_mix, hilbert_shards, near_dedup, quality_fm, warc_audit
from sensorloom.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def test_curve_visits_neighbours(spark):
    n = 1 << hilbert_shards.BITS
    cells = spark.range(n**3).select(*((F.floor(F.col("id") / n**k) % n).cast("int").alias(c) for k, c in enumerate("xyz")))
    got = cells.withColumn("h", hilbert_shards.hilbert_index(F.col("x"), F.col("y"), F.col("z"))).orderBy("h").collect()
    assert [r.h for r in got] == list(range(n**3))
    assert all(abs(a.x - b.x) + abs(a.y - b.y) + abs(a.z - b.z) == 1 for a, b in zip(got, got[1:], strict=False))


def check_shards(got, rows, shards=40):
    want = collections.Counter(
        (d, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for d, t in rows
    )
    assert collections.Counter((r.doc_id, r["size"], r.text_crc32) for r in got) == want
    slots = collections.defaultdict(list)
    for r in got:
        assert r.law == "rows" and r.grown_shard is None
        slots[r.shard].append((r.slot, r.curve))
    counts = [len(slots[s]) for s in range(shards)]
    assert max(counts) - min(counts) <= 1 and set(slots) <= set(range(shards))
    order = []
    for shard in range(shards):
        places = sorted(slots[shard])
        assert [p for p, _ in places] == list(range(len(places)))
        order += [c for _, c in places]
    assert order == sorted(order)


def test_shards_of_the_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    check_shards(QUERIES["op4_hilbert_shards"](spark, SF).collect(), [tuple(d) for d in docs])
    plan = QUERIES["op4_hilbert_shards"](spark, SF)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_shards_of_awkward_rows(awkward, none, awkward_rows):
    got = hilbert_shards.placed(awkward).collect()
    check_shards(got, [r[:2] for r in awkward_rows])
    assert hilbert_shards.placed(none).count() == 0
    again = hilbert_shards.placed(awkward.repartition(7)).collect()
    assert collections.Counter(map(tuple, got)) == collections.Counter(map(tuple, again))


def test_files_prune(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    hilbert_shards.write_shards(docs, str(tmp_path / "out"), 40)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.drop("slot").count() == docs.count()
    spread = back.groupBy("shard").agg(F.countDistinct("source").alias("n")).agg(F.avg("n")).first()[0]
    assert spread < 10  # of 20 sources


def test_written_shards_hold_every_row_once(spark, awkward, none, tmp_path):
    rows = [(1, "a"), (1, "b"), (2, "c"), (None, "d"), (None, "d"), (1, "a")] * 3
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"source": F.lit("s"), "lang": F.lit(None).cast("string")})
    for name, table in (("few", docs), ("awkward", awkward), ("none", none)):
        hilbert_shards.write_shards(table, str(tmp_path / name), 4)
        if name != "none":
            back = spark.read.parquet(str(tmp_path / name))
            counted = (collections.Counter((r.doc_id, r.text) for r in t.collect()) for t in (back, table))
            assert next(counted) == next(counted)
            places = collections.Counter((r.shard, r.slot) for r in back.collect())
            assert len(places) == table.count() and set(places) >= {(k, 0) for k in range(4)}


def test_steps_tell_whole_values_apart(spark):
    """Sources and languages that begin alike, beside one that shares no beginning with them."""
    sources = ["common_crawl", "common_voice", *(f"src{i}" for i in range(10)), *(f"src1{i}" for i in range(4))]
    langs = ["zh-cn", "zh-tw", "zh", None]
    rows = [(i, "w" * (i % 7), sources[i % 16], langs[i // 16 % 4]) for i in range(1600)]
    rows += [(2000, "w", "", "en"), (2001, "w", "hot", ""), (2002, "w", None, "en")]
    got = hilbert_shards.placed(spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")).collect()
    check_shards(got, [r[:2] for r in rows])
    of = {r[0]: r[2:] for r in rows if r[0] < 1600}
    steps = {(of[r.doc_id][0], r.source_step) for r in got if r.doc_id in of}
    assert len(steps) == len({s for _, s in steps}) == 16
    assert [s for s, _ in sorted(steps, key=lambda x: x[1])] == sorted(sources)
    steps = {(of[r.doc_id][1], r.lang_step) for r in got if r.doc_id in of}
    assert len(steps) == len({s for _, s in steps}) == 4


def levels(sizes, total=1.5, repeats=2.0):
    """Targets by sharing out and resharing what is above the caps, over and over."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    left, free, got = total * sum(sizes.values()), set(order), {}
    while free:
        unit = left / sum(weight[s] for s in free)
        full = [s for s in free if unit * weight[s] > repeats * sizes[s]]
        if not full:
            return got | {s: unit * weight[s] for s in free}
        for s in full:
            got[s] = repeats * sizes[s]
            left -= got[s]
            free.discard(s)
    return got


def check_mix(got, near):
    by = collections.defaultdict(list)
    for r in got:
        assert 0 <= r.taken <= 2 * r["size"]
        assert r.taken in (0, r["size"], 2 * r["size"])
        by[r.source].append(r)
    want = levels({s: sum(r["size"] for r in rows) for s, rows in by.items()})
    for source, rows in by.items():
        total = sum(r["size"] for r in rows)
        assert all(r.source_size == total and np.isclose(r.target, want[source]) for r in rows), source
        taken, mean = sum(r.taken for r in rows), want[source] / max(total, 1)
        assert abs(taken - want[source]) <= near(rows), source
        assert abs(sum(r.times for r in rows) - mean * len(rows)) <= 2.001, source


def test_mix_of_the_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    first = cube_mix.mix(docs).collect()
    assert len(first) == docs.count()
    check_mix(first, lambda rows: 0.05 * rows[0].target + 300)
    again = cube_mix.mix(docs.repartition(5)).collect()
    assert sorted(map(tuple, first)) == sorted(map(tuple, again))


def test_mix_of_awkward_rows(awkward, none, awkward_rows):
    got = cube_mix.mix(awkward).collect()
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0d]+", t or ""))
    want = collections.Counter((d, size(t), s) for d, t, _, s, _ in awkward_rows)
    assert collections.Counter((r.doc_id, r["size"], r.source) for r in got) == want
    check_mix(got, lambda rows: max(r["size"] for r in rows))
    assert cube_mix.mix(none).count() == 0
    assert cube_mix.mix(awkward.where("text IS NULL")).select("taken").first()[0] == 0


def test_rows_are_mixed_by_their_own_draw(spark):
    """Rows without an id, or with one for several, reach their source's target as others do."""
    rows = [(None, f"{i} " + "w " * 19, "a") for i in range(600)] + [(i % 7, f"{i} " + "w " * 39, "b") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("times", F.lit("own"))
    got = cube_mix.mixed(docs)
    assert got.columns == docs.columns
    words = {r.source: r.n for r in got.groupBy("source").agg(F.sum(F.size(F.split(F.trim("text"), " "))).alias("n")).collect()}
    for r in cube_mix.mix(docs).select("source", "target").distinct().collect():
        assert abs(words[r.source] - r.target) <= 40
    drawn = collections.Counter(r.times for r in cube_mix.mix(docs).collect())
    often = collections.Counter(r.text for r in got.collect())
    assert sum(drawn.values()) == 900 and collections.Counter(often.values()) == +collections.Counter({k: n for k, n in drawn.items() if k})


def test_mix_flies_in_groups(awkward, spark, monkeypatch):
    monkeypatch.setattr(cube_mix, "GROUP_ROWS", 16)
    rng = random.Random(2)
    rows = [(i, "w " * rng.choice([0, 1, 5, 5, 5, 40, 300]), rng.choice(["a", "a", "a", "b", "c", None])) for i in range(900)]
    got = cube_mix.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    check_mix(got, lambda rows: 310)


def test_flight_keeps_totals_and_expectations():
    rng = np.random.default_rng(3)
    taken = np.zeros(40)
    x, p = rng.integers(1, 500, 40).astype(float), rng.random(40) * 0.98 + 0.01
    for _ in range(3000):
        q = cube_mix.fly(x, p, rng, land=False)
        live = (q > 0) & (q < 1)
        assert live.sum() <= 2 and np.isclose(q.sum(), p.sum()) and np.isclose(q @ x, p @ x)
        taken += cube_mix.fly(x, p, rng, land=True)
    assert np.abs(taken / 3000 - p).max() < 0.05


@pytest.fixture
def replicas(spark):
    rng = random.Random(1)
    rows = [(i, f"http://h/{i}", "x" * rng.randint(0, 9000) + chr(97 + i % 26)) for i in range(600)]
    rows += [(None, "http://null", "n"), (1000, None, None), (1001, "", ""), (1002, "http://é", "漢" * 40_000), (7, "http://h/7", rows[7][2])]
    return spark.createDataFrame(rows, "page_id long, url string, html string"), rows


def test_audit_locates_damage(spark, replicas):
    pages, rows = replicas
    whole = warc_audit.manifest(warc_audit.records(pages.withColumn("segment", F.lit(1))), segment_bytes=1 << 18)
    assert whole.select("segment").distinct().count() > 5 and whole.count() == len(rows)
    placed = {}
    for r in whole.orderBy("segment", "offset").collect():
        assert placed.get(r.segment, 0) == r.offset
        placed[r.segment] = r.offset + r.length
    assert warc_audit.audit(whole, whole).count() == 0
    assert warc_audit.audit(whole.limit(0), whole.limit(0)).count() == 0
    lost, cut, flipped = [3, 250, 1002], [17], [599, 1000]
    damaged = whole.where(~F.coalesce(F.col("page_id").isin(lost), F.lit(False)))
    damaged = damaged.withColumn("length", F.when(F.col("page_id").isin(cut), F.col("length") - 1).otherwise(F.col("length")))
    damaged = damaged.withColumn("digest", F.when(F.col("page_id").isin(flipped), F.unhex(F.lit("00"))).otherwise(F.col("digest")))
    extra = whole.where("page_id = 20").withColumns({"page_id": F.lit(5000).cast("long"), "offset": F.col("offset") + 1})
    got = warc_audit.audit(whole, damaged.union(extra)).collect()
    want = {**dict.fromkeys(lost, "missing"), **dict.fromkeys(cut + flipped, "changed"), 5000: "extra"}
    assert {r.page_id: r.kind for r in got} == want and len(got) == len(want)
    assert warc_audit.audit(whole, whole.limit(0)).where("kind = 'missing'").count() == len(rows)


def test_only_branches_that_differ_are_followed(spark, replicas):
    pages, _ = replicas
    whole = warc_audit.manifest(warc_audit.records(pages), segment_bytes=1 << 30)
    changed = whole.withColumn("digest", F.when(F.col("page_id") == 300, F.unhex(F.lit("00"))).otherwise(F.col("digest")))
    trees = [warc_audit.tree(t, 3, "t") for t in (whole, changed)]
    found = None
    for level in (2, 1, 0):
        found = warc_audit._differing(trees[0][level], trees[1][level], found)
        assert found.count() == 1


def test_records_read_back_from_files(spark, replicas, tmp_path):
    import gzip

    pages, rows = replicas
    whole = warc_audit.records(pages).orderBy("page_id").collect()
    (tmp_path / "a.warc").write_bytes(b"".join(bytes(r.record) for r in whole[:300]))
    (tmp_path / "b.warc.gz").write_bytes(b"".join(gzip.compress(bytes(r.record)) for r in whole[300:]))
    back = warc_audit.read_warc(spark, str(tmp_path)).collect()
    assert sorted(bytes(r.record) for r in back) == sorted(bytes(r.record) for r in whole)
    assert {r.url for r in back} == {u or "" for _, u, _ in rows}


def test_pipeline_stages(spark):
    """Each stage against its own input, and the whole run."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "decontamination", "mixing", "sharding"]
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = [docs]
    for _, stage in corpus_pipeline.STAGES:
        rows.append(corpus_pipeline.written(stage(spark, rows[-1], SF), "test-stage"))
    for before, after in zip(rows[:4], rows[1:5], strict=True):
        assert after.columns == docs.columns
        assert after.exceptAll(after.intersect(before)).join(before, docs.columns, "left_anti").count() == 0
    scored = quality_fm.score(docs, quality_fm.train(docs, labels))
    assert rows[1].count() == scored.where("score >= 0.3").count() < docs.count()
    good = rows[0].join(labels, "doc_id").where("quality = 1")
    assert rows[1].join(good.select("doc_id"), "doc_id").count() > 0.97 * good.count()
    near = near_dedup.near_duplicates(rows[1])
    assert {r.doc_id for r in rows[2].select("doc_id").collect()} == {r.doc_id for r in near.where("kept").collect()}
    assert near_dedup.near_duplicates(rows[2]).where("NOT kept").count() == 0
    from sensorloom.llm.decontaminate import leaks

    benchmark = spark.read.parquet(f"{SF}/benchmark.parquet")
    held = {r.doc_id for r in leaks(rows[2], benchmark).collect()}
    assert held and {r.doc_id for r in rows[3].collect()} == {r.doc_id for r in rows[2].collect()} - held
    times = {r.doc_id: r.times for r in cube_mix.mix(rows[3]).collect() if r.times}
    assert collections.Counter(r.doc_id for r in rows[4].select("doc_id").collect()) == times
    check_shards(rows[5].collect(), [(r.doc_id, r.text) for r in rows[4].collect()])
    whole = corpus_pipeline.run(spark, SF)
    assert sorted(map(tuple, whole.select("doc_id", "shard", "slot").collect())) == sorted(
        map(tuple, rows[5].select("doc_id", "shard", "slot").collect())
    )


def test_pipeline_of_awkward_rows(spark, awkward, none, tmp_path):
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(0, "none of these words are in any document here at all")], "item_id long, text string").write.parquet(
        str(tmp_path / "benchmark.parquet")
    )
    for start in (awkward, none):
        docs = start
        for name, stage in corpus_pipeline.STAGES:
            docs = corpus_pipeline.written(stage(spark, docs, str(tmp_path)), "test-odd")
            assert name == "sharding" or docs.columns == awkward.columns
        assert (docs.count() > 0) == (start is awkward)
