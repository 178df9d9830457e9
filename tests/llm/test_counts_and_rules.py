"""Token counts, perplexity rules, quality classifier."""

import collections
import math
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from sensorloom.llm import perplexity_rules, quality_fm, token_counts
from sensorloom.llm.queries import QUERIES
from sensorloom.llm.words import chunks, find_words, shingle_hashes

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0d]+")


@pytest.fixture(scope="module")
def counter():
    return token_counts.load(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)


def library(texts):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return [len(e.ids) for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


def test_counts_match_the_library_on_odd_texts(counter):
    rng = random.Random(1)
    letters = [*"ab cd'stlmre\n\t  \r12!?é  \u0085\x1c\x1d漢字😀", "<|endoftext|>", "<|endof"]
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(3000)]
    texts += ["", "a" * 20_000, " " * 3000, "ab" * 9000]
    assert [counter.count(t) for t in texts] == library(texts)


def test_counts_of_the_table_match_the_library(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    want = dict(zip([d.doc_id for d in docs], library([d.text or "" for d in docs]), strict=True))
    got = QUERIES["op3_token_counts"](spark, SF).collect()
    assert {r.doc_id: r.n_tokens for r in got} == want and len(got) == len(docs)
    assert all(r.over_limit == (r.n_tokens > 1024) for r in got)


def test_counts_of_awkward_rows(awkward, none, counter, awkward_rows):
    got = token_counts.token_counts(awkward, counter).collect()
    want = collections.Counter(
        (d, len((t or "").encode()), n) for (d, t, *_), n in zip(awkward_rows, library([r[1] or "" for r in awkward_rows]), strict=True)
    )
    assert collections.Counter((r.doc_id, r.n_bytes, r.n_tokens) for r in got) == want
    assert token_counts.token_counts(none, counter).count() == 0


def base(text):
    words = WORD.findall(text or "")
    seen, lines = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            lines += line in seen
            seen.add(line)
    windows = collections.Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = {k for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for k in range(i, i + 8)}
    signs = len(re.findall(r"[#*$%&|<>]", text or ""))
    return len(words), sum(map(len, words)), signs, lines, len(covered)


def test_base_rules_of_awkward_rows(awkward, none, awkward_rows):
    got = perplexity_rules.rules(awkward).collect()
    counts = collections.Counter((r.doc_id, *(r[c] for c in perplexity_rules.COUNTS)) for r in got)
    assert counts == collections.Counter((d, *base(t)) for d, t, *_ in awkward_rows)
    for r in got:
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        assert not (r.base_failed and r.kept) and r.log_perplexity is not None
    assert perplexity_rules.rules(none).count() == 0


def kneser_ney(texts, order):
    """Modified Kneser-Ney by the book, on lists of symbols; probabilities per full gram."""
    grams = collections.Counter()
    for text in texts:
        line = [0] * (order - 1) + [int(perplexity_rules.CLASSES[b]) for b in text.encode()] + [63]
        grams.update(tuple(line[i : i + order]) for i in range(len(line) - order + 1))
    levels = {order: grams}
    for k in range(order - 1, 0, -1):
        levels[k] = collections.Counter(g[1:] for g in levels[k + 1])

    def off(k):
        n = [max(sum(c == i for c in levels[k].values()), 1) for i in range(1, 5)]
        y = n[0] / (n[0] + 2 * n[1])
        return [0, *(min(max(i - (i + 1) * y * n[i] / n[i - 1], 0.1), i - 0.1) for i in (1, 2, 3))]

    offs = {k: off(k) for k in levels}

    def p(gram):
        k = len(gram)
        if not k:
            return 1 / 64
        same = {g: c for g, c in levels[k].items() if g[:-1] == gram[:-1]}
        total, taken = sum(same.values()), sum(offs[k][min(c, 3)] for c in same.values())
        c = same.get(gram, 0)
        return (c - offs[k][min(c, 3)] + taken * p(gram[1:])) / total

    return grams, p


def test_model_matches_the_textbook():
    rng = random.Random(2)
    texts = ["".join(rng.choice("aab c.\n") for _ in range(rng.randint(0, 30))) for _ in range(30)] + [""]
    grams, p = kneser_ney(texts, perplexity_rules.ORDER)
    code = {g: sum(s << 6 * (3 - i) for i, s in enumerate(g)) for g in grams}
    codes = np.array(sorted(code.values()))
    counts = np.array([c for _, c in sorted((code[g], c) for g, c in grams.items())])
    model = perplexity_rules.Model.of({"en": (codes, counts), None: (codes, counts)})
    for gram in list(grams)[:60]:
        for language in ("en", None):
            got = model.log_probabilities(language, np.array([code[gram]], np.uint32))[0]
            assert math.isclose(got, math.log(p(gram)), rel_tol=1e-4), gram
    unseen = np.array([(5 << 18) | (6 << 12) | (7 << 6) | 8], np.uint32)
    assert -50 < model.log_probabilities("en", unseen)[0] < math.log(1 / 64) + 1
    assert -50 < model.log_probabilities("xx", unseen)[0] < 0


def test_models_of_many_languages_in_several_passes(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    whole = {r.doc_id: (r.kept, round(r.log_perplexity, 5)) for r in perplexity_rules.rules(docs).collect()}
    monkeypatch.setattr(perplexity_rules, "MODEL_ROWS", 1000)
    assert {r.doc_id: (r.kept, round(r.log_perplexity, 5)) for r in perplexity_rules.rules(docs).collect()} == whole


def test_rules_keep_clean_documents_and_reject_junk(spark):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    found = QUERIES["op8_perplexity_rules"](spark, sf).join(labels, "doc_id").toPandas()
    clean = found[(found.quality == 1) & ~found.base_failed]
    assert clean.kept.mean() > 0.93
    assert found[found.quality == 0].kept.mean() < 0.6


def test_classifier_on_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    got = QUERIES["op2_quality_fm"](spark, sf).collect()
    assert len(got) == 1000
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    held = [(r.score, labels[r.doc_id], r.predicted) for r in got if r.held_out and r.doc_id in labels]
    good, bad = ([s for s, y, _ in held if y == k] for k in (1, 0))
    assert good and bad
    above = np.mean([(a > b) + 0.5 * (a == b) for a in good for b in bad])
    assert above > 0.97, above
    assert np.mean([p == y for _, y, p in held]) > 0.9


def test_pairwise_terms_by_the_definition():
    rng = np.random.default_rng(1)
    size = quality_fm.WORDS + quality_fm.STATISTICS * quality_fm.BINS
    machine = quality_fm.Machine(0.3, rng.standard_normal(size), rng.standard_normal((size, 4)).astype(np.float32))
    slots, values = rng.choice(size, 12, replace=False), rng.random(12)
    pairs = sum(
        machine.factors[slots[i]] @ machine.factors[slots[j]] * values[i] * values[j] for i in range(12) for j in range(i)
    )
    want = 0.3 + machine.linear[slots] @ values + pairs
    assert np.allclose(machine.logits(slots, values, np.array([0, 12])), [want], rtol=1e-4)


def test_scores_of_awkward_rows(spark, awkward, none, awkward_rows):
    labels = spark.createDataFrame([(1, 1, 0), (None, 0, 0), (8, 0, 1), (8, 0, 1), (11, None, 0)], "doc_id long, quality int, toxic int")
    got = quality_fm.classify(awkward, labels).collect()
    assert len(got) == len(awkward_rows) and all(0 <= r.score <= 1 for r in got)
    assert quality_fm.classify(awkward, labels.limit(0)).where("score <> 0.5").count() == 0
    assert quality_fm.classify(none, labels).count() == 0
    kept = quality_fm.good(awkward, labels, least=0.0)
    assert kept.columns == awkward.columns and kept.count() == len(awkward_rows)


def test_labels_language_and_source_do_not_enter_scores(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    machine = quality_fm.train(docs, labels)
    changed = docs.withColumns({"lang": F.lit("xx"), "source": F.lit(None).cast("string"), "doc_id": F.col("doc_id") + 7})
    a, b = (sorted(r.score for r in quality_fm.score(d, machine).select("score").collect()) for d in (docs, changed))
    assert a == b


def test_shingles_and_words_of_a_chunk(awkward_rows):
    import pyarrow as pa

    texts = [r[1] for r in awkward_rows]
    batch = pa.RecordBatch.from_pydict({"text": pa.array(texts, pa.string())})
    at = 0
    for part, data, offsets in chunks(iter([batch])):
        words = find_words(data, offsets)
        hashes, begins = shingle_hashes(words.hashes(), words.first, 3)
        names = {}
        for i in range(part.num_rows):
            own = (texts[at + i] or "").encode().lower().split()
            want = [tuple(own[k : k + 3]) for k in range(len(own) - 2)] if len(own) >= 3 else [tuple(own)] if own else []
            got = hashes[begins[i] : begins[i + 1]].tolist()
            assert len(got) == len(want)
            for shingle, value in zip(want, got, strict=True):
                assert names.setdefault(shingle, value) == value
        assert len(set(names.values())) == len(names)
        at += part.num_rows


def test_model_of_whole_characters(spark):
    """Grams of code points, none folded into another, against the textbook; digits, signs and other scripts differ."""
    rng = random.Random(3)
    texts = ["".join(rng.choice("ab12#?éèж漢😀 \n") for _ in range(rng.randint(0, 40))) for _ in range(40)] + ["", None]
    order = perplexity_rules.ORDER
    own = {lang: [t for i, t in enumerate(texts) if i % 2 == k] for k, lang in enumerate(("en", None))}
    docs = spark.createDataFrame([(i, t, ["en", None][i % 2]) for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    got = perplexity_rules.rules(docs).collect()
    counted = perplexity_rules.count_grams(docs).groupBy("lang").count().collect()
    for lang, part in own.items():
        lines = [["^"] * (order - 1) + list(t or "") + ["$"] for t in part]
        grams = [[tuple(line[i : i + order]) for i in range(len(line) - order + 1)] for line in lines]
        levels = {order: collections.Counter(g for line in grams for g in line)}
        for k in range(order - 1, 0, -1):
            levels[k] = collections.Counter(g[1:] for g in levels[k + 1])
        assert {r.lang: r["count"] for r in counted}[lang] == len(levels[order])

        def p(gram):
            k = len(gram)
            if not k:
                return 1 / len(levels[1])
            n = [max(sum(c == i for c in levels[k].values()), 1) for i in range(1, 5)]
            off = [0, *(min(max(i - (i + 1) * n[0] / (n[0] + 2 * n[1]) * n[i] / n[i - 1], 0.1), i - 0.1) for i in (1, 2, 3))]
            same = {g: c for g, c in levels[k].items() if g[:-1] == gram[:-1]}
            c, taken = same[gram], sum(off[min(x, 3)] for x in same.values())
            return (c - off[min(c, 3)] + taken * p(gram[1:])) / sum(same.values())

        logs = {g: math.log(p(g)) for g in levels[order]}
        want = {i: -sum(logs[g] for g in line) / len(line) for i, line in zip([i for i, _ in enumerate(texts) if [*own].index(lang) == i % 2], grams)}
        for r in got:
            if r.doc_id in want:
                assert math.isclose(r.log_perplexity, want[r.doc_id], rel_tol=1e-5), r


def test_sums_of_several_ranges_of_hashes(spark, awkward, monkeypatch):
    whole = sorted((r.doc_id or 0, r.n_words, round(r.log_perplexity, 4)) for r in perplexity_rules.rules(awkward).collect())
    monkeypatch.setattr(perplexity_rules, "MODEL_ROWS", 10_000)
    monkeypatch.setattr(perplexity_rules, "TASK_ROWS", 500)
    got = sorted((r.doc_id or 0, r.n_words, round(r.log_perplexity, 4)) for r in perplexity_rules.rules(awkward).collect())
    assert got == whole
