import random
from collections import Counter

import numpy as np

from locusweave.llm import near_duplicates as N
from locusweave.llm import queries

from .conftest import DATA, needs_data


def brute(pairs):
    """Class of every row, all texts compared with all."""
    texts = {}
    for doc_id, text in pairs:
        texts.setdefault(text or "", []).append(doc_id)
    names = list(texts)
    shingled = [N.shingles(t) for t in names]
    parent = list(range(len(names)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(names)):
        for j in range(i):
            if len(shingled[i]) and len(shingled[j]) and find(i) != find(j) and N.compare(shingled[j], shingled[i])[0]:
                parent[find(i)] = find(j)
    members = {}
    for i, name in enumerate(names):
        members.setdefault(find(i), []).extend(texts[name])
    of = {}
    for ids in members.values():
        known = [x for x in ids if x is not None]
        for x in ids:
            of.setdefault(x, []).append((x, min(known) if known else None, len(ids)))
    return sorted((row for rows in of.values() for row in rows), key=str)


def edited(draw, words, edits):
    out = list(words)
    for _ in range(edits):
        out[draw.randrange(len(out))] = f"new{draw.randrange(10**6)}"
    return " ".join(out)


def cases():
    draw = random.Random(5)
    word = lambda: f"w{draw.randrange(3000)}"
    pairs = []
    for base in range(6):
        words = [word() for _ in range(draw.choice([30, 120, 400]))]
        pairs += [(base * 100 + i, edited(draw, words, draw.choice([0, 0, 1, 2, 3, 4, 6, 10]))) for i in range(25)]
    hot = [word() for _ in range(150)]
    pairs += [(1000 + i, edited(draw, hot, draw.randrange(7))) for i in range(150)]
    long = [word() for _ in range(140)]
    pairs += [(2000 + n, " ".join(long[:n])) for n in range(90, 141, 3)]  # a chain of beginnings
    passage = " ".join(word() for _ in range(60))
    pairs += [(3000 + i, f"{passage} {' '.join(word() for _ in range(60))}") for i in range(20)]  # share a passage only
    pairs += [(4000, None), (4001, ""), (4002, None), (4003, "..."), (4004, "one two"), (4005, "One, two"), (4006, "in " * 3000), (4007, "in " * 2900),
              (None, pairs[0][1]), (None, "nobody has this text at all"), (4008, "a b c d e f"), (4009, "a b c d e f g"), (1000, pairs[150][1])]
    return pairs


def test_classes_agree_with_brute_force(docs):
    pairs = cases()
    got = sorted((tuple(r) for r in N.near_duplicate_classes(docs(pairs)).collect()), key=str)
    assert got == brute(pairs)


def test_one_row_of_each_class_stays(docs):
    pairs = cases()
    kept = N.keep_first(docs(pairs))
    assert kept.columns == docs(pairs).columns
    rows = kept.collect()
    classes = Counter((c, n) if c is not None else ("none", i) for i, c, n in brute(pairs))
    assert len(rows) == len(classes)
    first = {c for _, c, _ in brute(pairs) if c is not None}
    assert {r.doc_id for r in rows} - {None} == first


def test_no_rows_and_no_pairs(docs):
    assert N.near_duplicate_classes(docs([])).count() == 0
    assert [tuple(r) for r in N.near_duplicate_classes(docs([(3, "alone in here")])).collect()] == [(3, 3, 1)]
    assert N.keep_first(docs([(3, "alone"), (3, "alone"), (4, "other")])).count() == 2


def test_alignment_counts_order():
    a = N.shingles(" ".join(f"x{i}" for i in range(100)))
    assert N.alignment(a, a) == (96, 96)
    turned = np.concatenate([a[50:], a[:50]])
    assert N.alignment(a, turned)[1] < 0.8 * 96 and not N.compare(a, turned)[0]
    assert N.shingles("in in in in in in in").tolist() == list(dict.fromkeys(N.shingles("in in in in in in in").tolist()))


def test_similar_texts_share_a_sketch():
    draw = random.Random(1)
    missed = 0
    for _ in range(200):
        words = [f"w{draw.randrange(5000)}" for _ in range(200)]
        other = edited(draw, words, 4)
        a, b = N.shingles(" ".join(words)), N.shingles(other)
        if N.compare(a, b)[0]:
            missed += not (N.sketch(a) == N.sketch(b)).any()
    assert missed == 0


@needs_data
def test_query_agrees_with_brute_force(spark):
    pairs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()]
    assert sorted((tuple(r) for r in queries.op5_near_duplicates(spark, DATA).collect()), key=str) == brute(pairs)


def test_later_links_join_earlier_classes(spark):
    pair = lambda *rows: spark.createDataFrame([(a.encode(), b.encode()) for a, b in rows], "a binary, b binary")
    roots = N.joined_components(None, pair(("b", "c"), ("x", "y"), ("m", "n")))
    roots = N.joined_components(roots, pair(("c", "y"), ("y", "a"), ("p", "q"), ("b", "c")))
    got = {bytes(r.unit).decode(): bytes(r.root).decode() for r in roots.collect()}
    assert got == dict(b="a", c="a", x="a", y="a", a="a", m="m", n="m", p="p", q="p")
    assert roots.count() == len(got)


def test_open_members_need_shingles_only_for_others_that_their_leader_leaves_open(spark):
    """Lone members need none, staying ones none without a far one, and far ones as few as the lengths allow."""
    left = spark.createDataFrame(
        [(b"alone", b"a", 10, 10, 8), (b"near", b"b", 10, 10, 10), (b"near", b"c", 10, 10, 10), (b"far", b"d", 20, 20, 18), (b"far", b"e", 20, 20, 18)],
        "leader binary, unit binary, n int, able int, shortest int")
    result = spark.createDataFrame(
        [(b"alone", b"a", 2, 4, [1, 2, 3, 4]), (b"near", b"b", 9, 1, [5]), (b"near", b"c", 9, 1, [6]), (b"far", b"d", 14, 6, [1, 2, 3, 4, 5, 6]),
         (b"far", b"e", 19, 1, [9])], "leader binary, unit binary, shared int, lacking int, rest array<long>")
    got = {bytes(r.unit).decode(): (r.stays, r.inside, r.rest) for r in N._met(left, result, 0.8).collect()}
    assert got == {"b": (True, True, []), "c": (True, True, []), "d": (False, False, [1, 2, 3]), "e": (True, False, [])}


def test_members_keep_only_shingles_that_another_class_of_their_leader_has(spark, monkeypatch):
    """Shingles of one member or one class are left out, the rest come rarest first, and parts give what the whole gives."""
    left = spark.createDataFrame(
        [(b"x", b"a", b"a"), (b"x", b"b", b"b"), (b"x", b"c", b"b"), (b"x", b"d", b"d"), (b"y", b"a", b"a"), (b"y", b"e", b"e")], "leader binary, unit binary, root binary")
    result = spark.createDataFrame(
        [(b"x", b"a", 7, [1, 2, 3, 10]), (b"x", b"b", 8, [2, 3, 4, 5]), (b"x", b"c", 9, [2, 4, 6]), (b"x", b"d", 6, []), (b"y", b"a", 5, [6, 8]), (b"y", b"e", 4, [8, 10]),
         (b"z", b"a", 3, [1, 2])], "leader binary, unit binary, shared int, rest array<long>")
    expected = {("x", "a"): (7, 2, [3, 2]), ("x", "b"): (8, 2, [3, 2]), ("x", "c"): (9, 1, [2]), ("x", "d"): (6, 0, []), ("y", "a"): (5, 1, [8]), ("y", "e"): (4, 1, [8])}
    for part in (N.PART, 3):
        monkeypatch.setattr(N, "PART", part)
        rows = N._held_by_others(left, result).collect()
        assert len(rows) == len(expected)
        assert {(bytes(r.leader).decode(), bytes(r.unit).decode()): (r.shared, r.lacking, r.rest) for r in rows} == expected


def test_shingles_that_only_other_groups_have_make_no_rows(docs, monkeypatch):
    """Open members of one leader share its passage only; what each else shares is with texts of other groups."""
    emitted = []
    met = N._met

    def counted(*args):
        got = met(*args)
        emitted.append(sum(len(r.rest) for r in got.collect()))
        return got

    monkeypatch.setattr(N, "_met", counted)
    draw = random.Random(8)
    words = lambda n: " ".join(f"w{draw.randrange(10**6)}" for _ in range(n))
    passages, tails = [words(60) for _ in range(4)], [words(15) for _ in range(20)]
    pairs = [(100 * g + t, f"{passage} {tail}") for g, passage in enumerate(passages) for t, tail in enumerate(tails)]
    assert sorted((tuple(r) for r in N.near_duplicate_classes(docs(pairs)).collect()), key=str) == brute(pairs)
    assert emitted and sum(emitted) == 0
