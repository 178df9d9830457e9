"""Near-duplicate documents, lines and passages; decontamination."""

import collections
import itertools
import random
import re
import time

import numpy as np
import pytest
from compare import oracle_rows, spark_rows
from conftest import prose  # tests/llm/conftest.py

from sensorloom.llm import decontaminate, line_dedup, near_dedup, passages
from sensorloom.llm.common import components
from sensorloom.llm.queries import ORACLES, QUERIES

WORD = re.compile(r"[^\x20\x09-\x0d]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def shingles(text, n):
    own = words(text)
    return {tuple(own[i : i + n]) for i in range(len(own) - n + 1)} if len(own) >= n else {tuple(own)} if own else set()


def smallest_reachable(nodes, links):
    top = {n: n for n in nodes}

    def root(x):
        while top[x] != x:
            x = top[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        top[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


@pytest.mark.parametrize("name", list(ORACLES))
@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_matches_sql(spark, name, sf):
    assert spark_rows(QUERIES[name](spark, f"/root/testdata/{sf}")) == oracle_rows(ORACLES[name], f"/root/testdata/{sf}")


def test_components_of_chains_stars_and_cycles(spark):
    rng = random.Random(4)
    links = [(i, i + 1) for i in range(0, 60)] + [(100, k) for k in range(101, 160)] + [(200, 201), (201, 202), (202, 200)]
    ids = list(range(1000, 1100))
    rng.shuffle(ids)
    links += list(itertools.pairwise(ids)) + [(5, 5), (100, 101), (7, None)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long"), "t").collect()}
    real = [(a, b) for a, b in links if b is not None and a != b]
    assert got == smallest_reachable({x for e in real for x in e}, real)
    assert components(spark.createDataFrame([], "a long, b long"), "t").count() == 0


def near_truth(rows, n, percent):
    by_id = collections.defaultdict(set)
    for doc, text in rows:
        if doc is not None:
            by_id[doc].add(frozenset(shingles(text, n)))
    links = [
        (a, b)
        for (a, xs), (b, ys) in itertools.combinations(by_id.items(), 2)
        if any(x and y and 100 * len(x & y) >= percent * len(x | y) for x in xs for y in ys)
    ]
    return smallest_reachable(list(by_id), links)


@pytest.mark.parametrize("n, percent", [(3, 85), (5, 80)])
def test_near_duplicates_of_awkward_rows(awkward, none, awkward_rows, n, percent):
    got = near_dedup.near_duplicates(awkward, shingle=n, percent=percent).collect()
    truth = near_truth([r[:2] for r in awkward_rows], n, percent)
    want = collections.Counter(
        (d, len(shingles(t, n)), truth.get(d), d is None or truth[d] == d) for d, t, *_ in awkward_rows
    )
    assert collections.Counter(tuple(r) for r in got) == want
    assert near_dedup.near_duplicates(none).count() == 0


def test_near_duplicates_of_a_large_loose_group(spark):
    """Members of one group that are often below the threshold to each other: links must not hang on the hubs."""
    rng = random.Random(9)
    base, rows = prose(rng, 120).split(), []
    for doc in range(400):
        own = base[:]
        for k in rng.sample(range(120), rng.choice([0, 1, 2, 4, 5, 6])):
            own[k] = prose(rng, 1)
        rows.append((doc, " ".join(own)))
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in near_dedup.near_duplicates(docs, shingle=3, percent=85).collect()}
    assert got == near_truth(rows, 3, 85)


def test_posterior_bounds():
    least = near_dedup.least_matches(0.85, 1e-6, 125, 25)
    assert len(least) == 5 and list(least) == sorted(least)
    assert all(need < 0.85 * n for need, n in zip(least, range(25, 126, 25), strict=True))
    strict = near_dedup.least_matches(0.85, 0.05, 125, 25)
    assert all(a > b for a, b in zip(strict, least, strict=True))


def test_one_of_each_keeps_one_row_per_group(awkward, awkward_rows):
    got = near_dedup.one_of_each(awkward, shingle=3, percent=85)
    assert got.columns == awkward.columns
    truth = near_truth([r[:2] for r in awkward_rows], 3, 85)
    want = collections.Counter({d for d in truth if truth[d] == d})
    want[None] = sum(r[0] is None for r in awkward_rows)
    assert collections.Counter(r.doc_id for r in got.select("doc_id").collect()) == want


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def edited(rng, text, n, letters="abcdé"):
    out = list(text)
    for _ in range(n):
        kind, at = rng.randint(0, 2), rng.randrange(len(out) + 1)
        if kind == 0 or at == len(out):
            out.insert(at, rng.choice(letters))
        elif kind == 1:
            del out[at]
        else:
            out[at] = rng.choice(letters)
    return "".join(out)


def test_banded_distance():
    rng = random.Random(3)
    for _ in range(6000):
        a = "".join(rng.choice("abcd") for _ in range(rng.randint(0, 12)))
        b = edited(rng, a, rng.randint(0, 4), "abcd")
        for k in range(4):
            assert line_dedup.within(a, b, k) == (distance(a, b) <= k), (a, b, k)


def line_truth(rows):
    lines = {line for _, t in rows for line in (t or "").split("\n") if WORD.search(line)}
    links = [
        (a, b)
        for a, b in itertools.combinations(sorted(lines), 2)
        if abs(len(a) - len(b)) <= 2
        and (k := min(max(len(a), len(b)) // 10, 2)) and line_dedup.within(a, b, k)
    ]
    return smallest_reachable(lines, links)


def check_lines(spark, docs, rows):
    got = line_dedup.near_duplicate_lines(docs).collect()
    truth = line_truth(rows)
    sizes = collections.Counter()
    heads, want = {}, collections.Counter()
    places = [
        (doc, no, line) for doc, t in rows for no, line in enumerate((t or "").split("\n")) if WORD.search(line)
    ]
    for doc, no, line in places:
        group, place = truth[line], (doc is None, doc or 0, no)
        sizes[group] += 1
        heads[group] = min(heads.get(group, place), place)
    for doc, no, line in places:
        group = truth[line]
        want[(doc, no, sizes[group], heads[group] == (doc is None, doc or 0, no))] += 1
    assert collections.Counter((r.doc_id, r.line_no, r.class_lines, r.kept) for r in got) == want
    # the same lines share a class
    named = collections.defaultdict(set)
    text_of = {(d, n): line for d, n, line in places}
    for r in got:
        named[truth[text_of[(r.doc_id, r.line_no)]]].add(r.class_id)
    assert all(len(ids) == 1 for ids in named.values()) and len({min(i) for i in named.values()}) == len(named)


def test_lines_against_brute_force(spark):
    rng, rows, lines = random.Random(6), [], []
    for _ in range(60):
        size = rng.choice([3, 8, 9, 10, 11, 18, 19, 20, 21, 40, 90])
        lines.append("".join(rng.choice("abcdefgh é漢") for _ in range(size)))
    lines += [edited(rng, x, rng.randint(0, 3)) for x in lines for _ in range(4)]
    hot = "".join(rng.choice("abcdefgh") for _ in range(60))
    lines += [edited(rng, hot, rng.randint(1, 4), "abcdefgh") for _ in range(150)]  # many share segments, not all are linked
    for doc in range(120):
        rows.append((doc, "\n".join(rng.choice(lines) for _ in range(rng.randint(0, 8)))))
    check_lines(spark, spark.createDataFrame(rows, "doc_id long, text string"), rows)


def test_lines_of_awkward_rows(spark, awkward, none, awkward_rows):
    ids = collections.Counter(r[0] for r in awkward_rows)
    rows = [r[:2] for r in awkward_rows if ids[r[0]] == 1]
    check_lines(spark, awkward.where("doc_id <> 2 OR doc_id IS NULL"), rows)
    assert line_dedup.near_duplicate_lines(none).count() == 0


def passage_truth(rows, least=50):
    """Words of each document in exact passages of `least` words that another document has."""
    owners = collections.defaultdict(set)
    for doc, text in rows:
        own = words(text)
        for k in range(len(own) - least + 1):
            owners[tuple(own[k : k + least])].add(doc)
    found = collections.defaultdict(set)
    for doc, text in rows:
        own = words(text)
        for k in range(len(own) - least + 1):
            if len(owners[tuple(own[k : k + least])]) > 1:
                found[doc].add(k)
    return found


def check_passages(got, rows):
    spans = collections.defaultdict(list)
    for r in got:
        assert r.n_words >= 50 and r.other_id != r.doc_id
        spans[r.doc_id].append((r.start_word, r.start_word + r.n_words))
    truth = passage_truth(rows)
    for doc, starts in truth.items():
        assert all(any(a <= k and k + 50 <= b for a, b in spans[doc]) for k in starts), doc
    return spans, truth


def test_passages_against_brute_force(spark):
    rng, rows = random.Random(8), []
    shared = [prose(rng, n) for n in (50, 51, 60, 90, 200)] + [prose(rng, 49)]
    license_ = prose(rng, 40)  # common, but too short
    for doc in range(150):
        parts = [prose(rng, rng.randint(0, 120))]
        if rng.random() < 0.4:
            parts += [rng.choice(shared), prose(rng, rng.randint(0, 60))]
        if rng.random() < 0.5:
            parts += [license_, prose(rng, 3)]
        rows.append((doc, " ".join(parts)))
    edit = shared[4].split()
    edit[100] = "substituted"
    del edit[150]
    rows += [(200, prose(rng, 30) + " " + " ".join(edit)), (201, " ".join(prose(rng, 1) for _ in range(300)))]
    got = passages.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    spans, truth = check_passages(got, rows)
    assert max(b - a for a, b in spans[200]) >= 190  # over a substitution and a deletion
    assert set(spans) <= set(truth) | {200}


def changed(rng, own, kind):
    """A list of words with one of them replaced, one added or one left out."""
    k = rng.randrange(1, len(own) - 1)
    return own[:k] + ([] if kind == "deletion" else [prose(rng, 1) + "x"]) + own[k + (kind != "insertion") :]


@pytest.mark.parametrize("kind", ["substitution", "insertion", "deletion"])
def test_passages_with_one_changed_word(spark, kind):
    rng, rows, want = random.Random(21), [], {}
    for pair in range(0, 240, 2):
        own = prose(rng, rng.randint(51, 60)).split()
        for doc, part in ((pair, own), (pair + 1, changed(rng, own, kind))):
            before = rng.randint(0, 60)
            rows.append((doc, " ".join([prose(rng, before), *part, prose(rng, rng.randint(0, 60))])))
            want[doc] = (before, before + len(part))
    spans = collections.defaultdict(list)
    for r in passages.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        spans[r.doc_id].append((r.start_word, r.start_word + r.n_words))
    # The first or last word can be the changed one's neighbour, and its few words no shingle.
    held = [doc for doc, (a, b) in want.items() if any(x <= a + 6 and b - 6 <= y for x, y in spans[doc])]
    assert len(held) >= 0.95 * len(want)


def test_shared_passages_against_brute_force():
    rng = random.Random(1)
    for _ in range(120):
        base, sides = [rng.randrange(rng.choice([6, 1000])) for _ in range(rng.randint(8, 20))], []
        for _ in range(2):
            own = base + base[: rng.choice([0, 0, 9])]
            for _ in range(rng.randint(0, 3)):
                k = rng.randrange(len(own))
                own[k : k + rng.randint(0, 1)] = [rng.randrange(10**6)] * rng.randint(0, 1)
            sides.append([rng.randrange(50) for _ in range(rng.randint(0, 5))] + own + [rng.randrange(50) for _ in range(rng.randint(0, 5))])
        a, b = sides
        want = set()
        for i, j in itertools.product(range(len(a)), range(len(b))):
            for u, v in itertools.product(range(i + 8, len(a) + 1), range(j + 8, len(b) + 1)):
                if a[i] == b[j] and a[u - 1] == b[v - 1]:
                    x, y = set(a[i:u]), set(b[j:v])
                    if 100 * len(x & y) >= 80 * len(x | y):
                        want |= {(0, k) for k in range(i, u)} | {(1, k) for k in range(j, v)}
        got = passages.shared_passages(np.array(a, np.uint64), np.array(b, np.uint64), 8, 80)
        assert {(0, k) for p in got for k in range(p[0], p[1])} | {(1, k) for p in got for k in range(p[2], p[3])} == want


def test_shared_passages_cost_a_few_sorts():
    """A pair with one passage in common takes no more than a few sorts of its shingles."""
    rng = np.random.default_rng(3)
    pairs, want = [], []
    for _ in range(60):
        a, b = rng.integers(0, 1 << 63, (2, 900)).astype(np.uint64)
        i, j, n = rng.integers(0, 800), rng.integers(0, 800), rng.integers(46, 90)
        b[j : j + n] = a[i : i + n]
        pairs.append((a, b))
        want.append([(i, i + n, j, j + n)])

    def seconds(f):
        took = []
        for _ in range(7):
            start = time.process_time()
            found = [f(a, b) for a, b in pairs]
            took.append(time.process_time() - start)
        return min(took), found

    took, got = seconds(lambda a, b: passages.shared_passages(a, b, 46, 80))
    sorts, _ = seconds(lambda a, b: np.unique(np.concatenate((a, b)), return_inverse=True))
    assert got == want and took < 3 * sorts


def check_classes(got, rows):
    """All places of an exact passage in different texts have a class in common."""
    classes, owners = collections.defaultdict(list), collections.defaultdict(set)
    for r in got:
        classes[r.doc_id].append((r.start_word, r.start_word + r.n_words, r.class_id))
    for doc, text in rows:
        own = words(text)
        for k in range(len(own) - 49):
            owners[tuple(own[k : k + 50])].add((doc, k))
    for places in owners.values():
        if len({doc for doc, _ in places}) > 1:
            assert set.intersection(*({name for a, b, name in classes[doc] if a <= k and k + 50 <= b} for doc, k in places)), places


def test_exact_passages_among_units_with_a_part_of_it(spark):
    """Most units that share the windows' surroundings hold a part that is too short; those with the whole are linked all the same."""
    rng, rows = random.Random(41), []
    for _ in range(12):
        passage = prose(rng, 52).split()
        for k in range(28):
            own = passage if k > 24 else passage[2:50]
            rows.append((len(rows), " ".join([prose(rng, 20), *own, prose(rng, rng.randint(5, 30))])))
    got = passages.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    spans, truth = check_passages(got, rows)
    assert set(spans) == set(truth) == {k for k in range(len(rows)) if k % 28 > 24}
    check_classes(got, rows)
    assert len({r.class_id for r in got}) == 12


def test_classes_of_passages(spark):
    """Units that are only linked with the smallest one have its class; other passages of a document have others."""
    rng, rows = random.Random(43), []
    shared = [prose(rng, n) for n in (50, 60, 75, 120)]
    for doc in range(90):
        parts = [prose(rng, rng.randint(1, 40))]
        for own in rng.sample(shared, rng.choice([0, 1, 1, 2, 3])):
            cut = own.split()[: rng.choice([50, 60, 200])]
            parts += [" ".join(cut), prose(rng, rng.randint(60, 90))]  # too far apart to be one passage
        rows.append((doc, " ".join(parts)))
    rows += [(200, shared[3]), (201, shared[3])]
    got = passages.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    check_classes([r for r in got if r.doc_id != 201], rows[:-1])
    assert len({r.class_id for r in got}) == 5  # that of the equal texts too
    assert {r.class_id for r in got if r.doc_id == 201} < {r.class_id for r in got if r.doc_id == 200}


def test_passages_twice_in_the_smallest_unit(spark):
    """Whichever unit is the smallest, it or another has the passage twice, once behind a part of it."""
    rng, rows = random.Random(31), []
    for pair in range(0, 60, 2):
        passage = prose(rng, 50)
        part = " ".join(passage.split()[10:35])
        rows.append((pair, " ".join([part, prose(rng, 20), passage, prose(rng, 30), passage, prose(rng, 9)])))
        rows.append((pair + 1, " ".join([prose(rng, 25), passage, prose(rng, 12)])))
    check_passages(passages.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect(), rows)


def test_passages_shared_with_different_documents(spark):
    """A document that shares other passages with each of five others, overlapping ones too, has a row for each."""
    rng = random.Random(12)
    own = [prose(rng, 80) for _ in range(5)]
    rows = [(0, " ".join(own))] + [(k + 1, " ".join([prose(rng, 20), part, prose(rng, 30)])) for k, part in enumerate(own)]
    rows += [(10, " ".join(" ".join(own).split()[40:120]) + " " + prose(rng, 20))]
    got = passages.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    links = {(r.doc_id, r.other_id): (r.start_word, r.n_words) for r in got}
    for k in range(5):
        assert links[0, k + 1] == (80 * k, 80) and links[k + 1, 0] == (20, 80)
    assert links[10, 0] == (0, 80)
    assert len(links) == len(got)


def test_windows_that_intersect():
    rng = random.Random(4)
    hits = 0
    for _ in range(600):
        rows = []
        for _ in range(rng.randint(1, 9)):
            row = [rng.randrange(3)]
            for _ in range(2):
                first = rng.randrange(30)
                end = first + rng.randint(10, 25)
                row += [first, rng.randrange(first, end), end]
            rows.append(row)
        want = any(
            x[0] != y[0]
            and all(
                any(s <= min(x[c], y[c]) and max(x[c], y[c]) < s + size for size in range(10, 30)
                    for s in range(max(x[c - 1], y[c - 1]), min(x[c + 1], y[c + 1]) - size + 1))
                for c in (2, 5)
            )
            for x in rows for y in rows
        )
        hits += want
        assert passages.intersect(np.array(rows, np.int32), 10, 2) == want
    assert 100 < hits < 500
    assert passages.merged([(8, 9), (0, 3), (3, 5), (1, 2)]) == [(0, 5), (8, 9)]


def test_passages_of_awkward_rows(awkward, none, awkward_rows):
    got = passages.repeated_passages(awkward).collect()
    rows = [r[:2] for r in awkward_rows if r[0] is not None]
    spans, _ = check_passages(got, rows)
    assert {1, 2, 3, 4, 14, 15} <= set(spans) and not {5, 6, 7, 8, 9, 11, None} & set(spans)
    assert passages.repeated_passages(none).count() == 0


def test_masks_meet_every_allowed_window():
    for size in range(decontaminate.LEAST_WORDS, 14):
        for gone in itertools.combinations(range(size), size - -(-80 * size // 100)):
            assert any(
                not any(at + o in gone for o in mask)
                for mask in decontaminate.MASKS
                for at in range(size - mask[-1])
            ), (size, gone)


def test_leaks_with_substitutions(spark):
    rng = random.Random(12)
    items = [(i, prose(rng, n)) for i, n in enumerate([7, 8, 10, 13, 14, 40])] + [(90, None), (91, ""), (None, prose(rng, 20))]
    docs, want = [], set()
    for doc in range(120):
        item, text = items[doc % 6]
        own = text.split()
        size = min(13, len(own))
        swaps = rng.randint(0, 4)
        for k in rng.sample(range(size), min(swaps, size)):
            own[k] = f"zz{k}"
        own = own[:size]  # only one window is there
        if 100 * (size - min(swaps, size)) >= (80 if size >= 8 else 100) * size:
            want.add((doc, item))
        docs.append((doc, prose(rng, 30) + ". " + " ".join(own).title() + "! " + prose(rng, 30)))
    docs += [(None, items[5][1]), (500, None), (501, ""), (502, "short"), (503, items[5][1]), (503, items[5][1]), (503, "x")]
    want.add((503, 5))
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    benchmark = spark.createDataFrame(items + items[:2], "item_id long, text string")
    got = decontaminate.leaks(docs, benchmark)
    assert {(r.doc_id, r.item_id) for r in got.collect()} == want and got.count() == len(want)
    left = collections.Counter(r.doc_id for r in docs.collect())
    left.subtract([*{d for d, _ in want}, 503, None])  # of 503 two rows hold the item, the third doesn't
    assert collections.Counter(r.doc_id for r in decontaminate.clean(docs, benchmark).collect()) == +left
    assert decontaminate.leaks(docs, benchmark.limit(0)).count() == 0
    assert decontaminate.leaks(docs.limit(0), benchmark).count() == 0


def test_short_and_unspaced_items(spark):
    items = [(1, "what is the capital of France?"), (2, "日本の首都はどこですか、東京です"), (3, "yes"), (4, "two words"), (5, "ประเทศไทย")]
    docs = [
        (1, "So: What is the capital of france? Paris."), (2, "質問。日本の首都はどこですか。東京です！"), (3, "yes"), (4, "yesterday two, words"),
        (5, "what is the capitol of france"), (6, "日本の首都"), (7, "two more words"), (8, "ในประเทศไทย"), (9, None), (None, "yes yes"),
    ]
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    got = decontaminate.leaks(docs, spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r.doc_id, r.item_id) for r in got} == {(1, 1), (2, 2), (3, 3), (4, 4), (8, 5)}
    assert all(r.matched == r.window_matched == r.item_words for r in got if r.item_words < 8)


def test_decontamination_runs_no_python(spark, capsys):
    sf = "/root/testdata/sf0.001"
    plan = QUERIES["op5_decontaminate"](spark, sf)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
