"""SimHash groups, line dedup, vector neighbours and near-duplicates against brute force."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict
from itertools import combinations
from pathlib import Path

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from millrace.llm import buckets, flatgraph, lines, neighbours, simhash
from millrace.llm.buckets import bucket_links
from millrace.llm.components import components
from millrace.llm.queries import QUERIES, op1_neighbours, op7_simhash, op9_flatgraph

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, ID long, component string"


def groups_of(nodes, links) -> dict:
    """Smallest reachable node, the slow way."""
    label = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(label[a], label[b])
            if label[a] != low or label[b] != low:
                label[a] = label[b] = low
                changed = True
    return label


def slow_print(text: str | None, words: int) -> int:
    text = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    parts = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not parts:
        return 0
    shingles = [" ".join(parts[i : i + words]) for i in range(max(1, len(parts) - words + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("seed", range(3))
def test_components_match_brute_force(spark, seed):
    rng = random.Random(seed)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(i, i + 1) for i in range(100, 130)]
    edges += [(200, i) for i in range(201, 230)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    want = groups_of({x for e in edges for x in e}, edges)
    linked = {x for a, b in edges if a != b for x in (a, b)}
    assert got == {n: c for n, c in want.items() if n in linked}


def test_components_of_nothing(spark):
    edges = spark.createDataFrame([(1, 1), (None, 2)], "a long, b long")
    assert components(edges, "a", "b").count() == 0


def test_bucket_links_keep_the_components(spark):
    rng = random.Random(5)
    keyed = [(rng.randrange(12), rng.randrange(1 << 10)) for _ in range(150)]
    near = lambda a, b: F.bit_count(a.bitwiseXOR(b)) <= 3
    links = bucket_links(spark.createDataFrame(keyed, "key int, item long").distinct(), near)
    got = [(r["a"], r["b"]) for r in links.collect()]
    want = {(min(x, y), max(x, y)) for (k, x), (m, y) in combinations(set(keyed), 2) if k == m and x != y and (x ^ y).bit_count() <= 3}
    assert set(got) <= want
    items = {i for _, i in keyed}
    assert groups_of(items, got) == groups_of(items, want)


def test_one_hot_bucket_gives_a_link_per_member(spark):
    keyed = spark.createDataFrame([(1, i) for i in range(400)], "key int, item long")
    assert bucket_links(keyed, lambda a, b: F.lit(True)).count() == 399


def flat_links(spark, rows: list[tuple], holds: set) -> tuple[list, int]:
    """Ids linked among ``(key, id)`` whose pairs hold as given, and how many pairs were verified."""
    right = spark.createDataFrame(sorted(holds), "p long, q long")
    seen = []

    def verify(pairs):
        seen.append(pairs.count())
        return pairs.join(right, (F.col("a.id") == F.col("p")) & (F.col("b.id") == F.col("q")), "left_semi")

    keyed = spark.createDataFrame(rows, "key long, id long")
    order = lambda a, b: F.abs(a["id"] - b["id"])
    links = bucket_links(keyed, None, verify, lambda a, b, key: F.lit(True), order)
    return [(r["a"]["id"], r["b"]["id"]) for r in links.collect()], sum(seen)


@pytest.mark.parametrize("seed", range(2))
def test_verified_bucket_links_keep_the_components(spark, seed):
    rng = random.Random(seed)
    rows = list({(rng.randrange(6), rng.randrange(60)) for _ in range(120)})
    met = {(min(x, y), max(x, y)) for (k, x), (m, y) in combinations(rows, 2) if k == m and x != y}
    holds = {p for p in sorted(met) if rng.random() < 0.06}
    got, _ = flat_links(spark, rows, holds)
    assert set(got) <= holds
    assert groups_of(range(60), got) == groups_of(range(60), holds)


def test_a_group_of_near_copies_is_met_once_per_label(spark):
    """Ten items that the first of the bucket misses hold with each of its forty: 400 pairs, of which ten tell all."""
    members, others = range(1, 41), range(41, 51)
    holds = {(0, m) for m in members} | {(m, o) for m in members for o in others}
    got, verified = flat_links(spark, [(7, i) for i in range(51)], holds)
    assert set(groups_of(range(51), got).values()) == {0}
    assert verified <= 50 + 10 + 45


def test_line_dedup_keeps_no_table_of_lines(spark, monkeypatch):
    made = []
    monkeypatch.setattr(lines.Scratch, "keep", lambda self, df, keep=lines.Scratch.keep: made.append((self.label, kept := keep(self, df))) or kept)
    docs = spark.createDataFrame([(i, f"one line of some words\nanother line {chr(97 + i)}") for i in range(4)], "doc_id long, text string")
    out, dropped = lines.drop_repeated_lines(docs)
    assert [r[dropped] for r in out.orderBy("doc_id").collect()][1:] == [[0]] * 3
    columns = [set(kept.columns) for label, kept in made if label == "lines" and Path(kept.inputFiles()[0].removeprefix("file://")).exists()]
    assert columns == [{"doc", "body", "lines"}]


def test_golay_keys_are_shuffled_once(spark, no_broadcast, monkeypatch):
    plans = []

    def kept(self, df, keep=simhash.Scratch.keep):
        df.collect()
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return keep(self, df)

    monkeypatch.setattr(simhash.Scratch, "keep", kept)
    apart = 1 | 1 << 25 | 1 << 45  # a bit in each segment
    rows = [(p,) for p in (random.Random(i).getrandbits(62) for i in range(60)) for p in (p, p ^ apart)]
    assert simhash.close_links(spark.createDataFrame(rows, "fp long")).count() == 60
    joined = [p.split("Initial Plan")[0] for p in plans if "a_lead" in p]
    assert len(joined) == 1 and "ReusedExchange" in joined[0] and "MapInArrow" not in joined[0]


def test_golay_decoding_is_perfect():
    upper, errors = simhash.golay_tables()
    assert len(np.unique(errors)) == 2048
    rng = np.random.default_rng(1)
    words = rng.integers(0, 1 << 23, 2000)
    code = words ^ errors[(words & 0x7FF) ^ upper[words >> 11]]
    assert (((code & 0x7FF) ^ upper[code >> 11]) == 0).all()
    assert (np.bitwise_count(words ^ code) <= 3).all()


@pytest.mark.parametrize("flips", [0, 1, 2])
def test_words_within_two_bits_share_a_key(flips):
    rng = np.random.default_rng(flips)
    words = rng.integers(0, 1 << 21, 500)
    other = words.copy()
    for i in range(len(words)):
        for bit in rng.choice(21, flips, replace=False):
            other[i] ^= 1 << bit
    left, first = simhash.segment_keys(words, 21)
    right, _ = simhash.segment_keys(other, 21)
    assert all(set(a) & set(b) for a, b in zip(left, right))
    assert set(first.sum(axis=1)) <= {1, 2, 3, 4, 5, 6}


def test_fingerprints_at_any_four_bits_are_linked(spark):
    rng = random.Random(9)
    prints = []
    for _ in range(60):
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample(range(64), rng.choice([1, 2, 3, 4, 4, 5, 6])):
            b ^= 1 << bit
        prints += [a, b]
    signed = np.array(sorted(set(prints)), dtype=np.uint64).view(np.int64).tolist()
    links = simhash.close_links(spark.createDataFrame([(x,) for x in signed], "fp long"))
    got = {(r["a"], r["b"]) for r in links.collect()}
    want = {(min(x, y), max(x, y)) for x, y in combinations(signed, 2) if ((x ^ y) & (2**64 - 1)).bit_count() <= 4}
    assert got <= want and groups_of(signed, got) == groups_of(signed, want)


def test_simhash_query_matches_brute_force(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    prints = {i: slow_print(t, 4) for i, t in docs}
    links = [(i, j) for i, j in combinations(prints, 2) if (prints[i] ^ prints[j]).bit_count() <= 4]
    want = groups_of(prints, links)
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in op7_simhash(spark, SF).collect()}
    assert got == {i: (f"{p:016x}", want[i]) for i, p in prints.items()}


def test_simhash_edges(spark):
    long = "Word " * 30_000
    rows = [(5, None), (3, ""), (9, " \t\n"), (7, long), (8, long), (8, long), (None, "alone here"), (1, "a b"), (2, "A  B"), (4, "ÀB c")]
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], DOCS)
    got = sorted(map(tuple, simhash.simhash_groups(docs).select("id", "component").collect()), key=str)
    assert got == sorted([(5, 3), (3, 3), (9, 3), (7, 7), (8, 7), (8, 7), (None, None), (1, 1), (2, 1), (4, 4)], key=str)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == [1, 3, 4, 7, None]
    empty = docs.filter("false")
    assert simhash.simhash_groups(empty).count() == 0 and simhash.keep_one(empty).count() == 0


def slow_distance(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_edit_distance_matches_the_table():
    rng = random.Random(2)
    for _ in range(1500):
        a, b = ("".join(rng.choices("abcé", k=rng.randrange(14))) for _ in range(2))
        assert lines.edit_distance(a, b) == slow_distance(a, b)


def slow_lines(text: str) -> list[tuple[int, str]]:
    """Number and normalised text of each line with words."""
    out = []
    for number, line in enumerate((text or "").lower().encode().split(b"\n")):
        words = re.findall(rb"[a-z0-9_\x80-\xff]+", line)
        if words:
            out.append((number, re.sub(rb"[0-9]", b"0", b" ".join(words)).decode()))
    return out


def print_of(line: str) -> int:
    return int(lines.split_lines(line.lower().encode())[2][0])


def test_lines_are_split_and_hashed_like_brute_force():
    rng = random.Random(1)
    names = {}
    for _ in range(2000):
        text = "".join(rng.choices("aB é1 2\n\n.,_-\t中", k=rng.randrange(40)))
        number, ids, _, shown, bounds = lines.split_lines(text.lower().encode())
        got = [(int(n), shown[bounds[i] : bounds[i + 1]].tobytes().decode()) for i, n in enumerate(number)]
        assert got == slow_lines(text)
        for (_, words), i in zip(got, ids.tolist()):
            assert names.setdefault(words, i) == i
    assert len(set(names.values())) == len(names)


def test_line_fingerprints_match_brute_force():
    rng = np.random.default_rng(3)
    lengths = np.array([1, 2, 5, 400, 3])
    hashes = rng.integers(0, 1 << 63, lengths.sum(), dtype=np.uint64)
    got = lines.simhashes(hashes, lengths, block=7).tolist()
    parts = np.split(hashes, np.cumsum(lengths)[:-1])
    want = [sum(1 << b for b in range(64) if 2 * sum(int(h) >> b & 1 for h in p) > len(p)) for p in parts]
    assert got == want


def test_lines_lose_exact_and_near_repeats(spark):
    base = " ".join(f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60))
    others = ("".join(random.Random(i).choices("abcdefgh", k=7)) for i in range(2000))
    texts = (base.replace("wordca ", f"{w} ") for w in others)
    near = next(t for t in texts if (print_of(base) ^ print_of(t)).bit_count() == 3)
    rows = [
        (1, f"{base}\nHello, World 12\nunique one"),
        (2, f"hello world 34!\n{near}\n\n---\nother line"),
        (3, None),
        (4, ""),
        (None, base.upper()),
        (2, "again and again\nagain and again"),
    ]
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], DOCS)
    out, dropped = lines.drop_repeated_lines(docs)
    assert out.columns == [*docs.columns, dropped]
    got = sorted(((r["doc_id"], r["text"]) for r in out.collect()), key=str)
    assert got == sorted(
        [(1, rows[0][1]), (2, "\n---\nother line"), (3, None), (4, ""), (None, ""), (2, "again and again")], key=str
    )
    assert lines.drop_repeated_lines(docs.filter("false"))[0].count() == 0


def whole_print(words: list[str]) -> int:
    """Fingerprint of all words, short ones too."""
    hashes = np.array([print_of(w) for w in words], dtype=np.uint64)
    return int(lines.simhashes(hashes, np.array([len(words)]))[0])


def with_one_word_changed(words: list[str], place: int) -> list[str]:
    """The words with one replaced, so that the fingerprint changes by three bits at most."""
    size = len(words[place])
    others = ("".join(random.Random(i).choices("abcdefgh", k=size)) for i in range(5000))
    changed = ([*words[:place], w, *words[place + 1 :]] for w in others)
    return next(c for c in changed if 0 < (whole_print(words) ^ whole_print(c)).bit_count() <= 3)


def dropped_of(spark, texts: list[str]) -> list:
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in enumerate(texts)], DOCS)
    out, dropped = lines.drop_repeated_lines(docs)
    return [r[dropped] for r in out.orderBy("doc_id").collect()]


def test_short_words_count_in_fingerprints(spark):
    short = [f"{a}{b}" for a in "klmnopq" for b in "aeiou"]
    words = [*short, "houses", "gardens", "rivers"]
    changed = with_one_word_changed(words, len(words) - 1)
    assert dropped_of(spark, [" ".join(words), " ".join(changed)]) == [None, [0]]


def test_lines_of_one_fingerprint_are_compared_each(spark):
    words = [f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60)]
    turned = words[::-1]
    assert whole_print(words) == whole_print(turned)
    texts = [words, turned, with_one_word_changed(words, 20), with_one_word_changed(turned, 20)]
    assert dropped_of(spark, [" ".join(t) for t in texts]) == [None, None, [0], [0]]


def test_lines_all_exact_repeats_go_and_nothing_unlike(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before = {r["doc_id"]: r["text"] for r in docs.collect()}
    out = {r["doc_id"]: r["dropped_lines"] for r in QUERIES["op4_lines"](spark, SF).collect()}
    first, gone, kept = {}, [], set()
    for i in sorted(before):
        for number, text in slow_lines(before[i]):
            (gone.append(text) if number in (out[i] or []) else kept.add(text))
            assert (text not in first) or number in (out[i] or [])
            first.setdefault(text, i)
    assert gone and all(t in kept or any(lines.similar(t, k, 0.8) for k in kept) or any(lines.similar(t, g, 0.8) for g in gone if g != t) for t in gone)


def test_near_lines_of_a_table_meet(spark):
    """Brute force over all distinct lines of sf0.001: nine in ten near pairs at least are joined."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    table = lines.line_table(docs, "doc_id", "text")
    distinct = table.groupBy("id").agg(F.min("sim").alias("sim"), F.min("runs").alias("runs"), F.min("words").alias("words"), F.min("size").alias("size")).cache()
    assert distinct.filter("size != char_length(words)").count() == 0
    links = bucket_links(lines._keys(distinct), None, lines._verified(table, 0.8), lines._near()).select(F.col("a.id").alias("x"), F.col("b.id").alias("y"))
    group = {r["node"]: r["component"] for r in components(links, "x", "y").collect()}
    rows = sorted(((r["words"], r["id"]) for r in distinct.collect()), key=lambda r: len(r[0]))
    pairs, bags = [], [Counter(words) for words, _ in rows]
    for i, (words, one) in enumerate(rows):
        for j in range(i + 1, len(rows)):
            longer, other = rows[j]
            allowed = int(0.2 * len(longer) + 1e-9)
            if len(longer) - len(words) > allowed:
                break
            if (bags[j] - bags[i]).total() <= allowed and lines.similar(words, longer, 0.8):
                pairs.append((one, other))
    joined = sum(x in group and group[x] == group.get(y) for x, y in pairs)
    assert len(pairs) >= 20 and joined >= 0.9 * len(pairs), (joined, len(pairs))


@pytest.mark.parametrize("step", [1, 2, 3, 7, 1000])
def test_runs_of_keys_as_rows_pass_by(step):
    rng = random.Random(step)
    rows = sorted((rng.randrange(40) ** 2 // 30, rng.randrange(9), i) for i in range(300))
    runs, got = buckets.Runs(), []
    for start in range(0, len(rows), step):
        columns = [np.array(c) for c in zip(*rows[start : start + step])]
        for found in runs.add(columns):
            got += zip(*(c.tolist() for c in found))
    for found in runs.end():
        got += zip(*(c.tolist() for c in found))
    of_key = defaultdict(list)
    for row in rows:
        of_key[row[0]].append(row)
    want = []
    for of in of_key.values():
        shown = [] if len(of) == 1 else of[1:] if len(of) == 2 else of
        want += [(*row, *of[0][1:], min(len(of), 3)) for row in shown]
    assert sorted(got) == sorted(want)


def test_smallest_runs_match_brute_force():
    rng = random.Random(4)
    counts = np.array([rng.randrange(1, 12) for _ in range(60)])
    hashes = np.array([rng.randrange(6) for _ in range(counts.sum())], dtype=np.uint64)
    runs, borders = lines.smallest_runs(hashes, counts)
    start = 0
    for i, n in enumerate(counts):
        words, start = hashes[start : start + n], start + n
        alone = {int(lines.smallest_runs(words[k : k + 3], np.array([3]))[0][0]) for k in range(n - 2)}
        assert runs[borders[i] : borders[i + 1]].tolist() == sorted(alone)[: lines.RUNS_KEPT]
    assert [len(a) for a in lines.smallest_runs(hashes[:0], counts[:0])] == [0, 1]


def test_distance_that_stops_early_says_the_same():
    rng = random.Random(9)
    for _ in range(400):
        a = "".join(rng.choices("ab ", k=rng.randrange(40)))
        b = "".join(rng.choices("ab ", k=rng.randrange(40)))
        most = rng.randrange(12)
        assert (lines.edit_distance(a, b, most) <= most) == (lines.edit_distance(a, b) <= most)


def test_lines_written_anew_are_no_farther_than_that():
    rng = random.Random(10)
    words = ["a", "bb", "the", "house", "river"]
    taken = 0
    for _ in range(1500):
        x = rng.choices(words, k=rng.randrange(1, 14))
        y = list(x)
        for _ in range(rng.randrange(4)):
            at = rng.randrange(len(y) + 1)
            y[at : at + rng.randrange(3)] = rng.choices(words, k=rng.randrange(3))
        allowed = rng.randrange(12)
        if y and lines.rewritten(x, y, allowed):
            taken += 1
            assert slow_distance(" ".join(x), " ".join(y)) <= allowed, (x, y)
    assert taken > 300


def vectors(spark, rows):
    return spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, embedding array<float>, ID long, v string")


ODD = [(101, None), (102, []), (103, [0.0, 0.0, 0.0]), (104, [1.0, None, 0.0]), (105, [float("nan"), 1.0, 0.0]), (106, [1.0, 2.0]), (None, [1.0, 0.0, 0.0])]


def test_neighbours_of_odd_vectors(spark):
    rows = [(i, [float(i), 1.0, 0.5]) for i in range(1, 8)] + [(20, [3.0, 1.0, 0.5])] + ODD
    df = vectors(spark, rows)
    got = neighbours.nearest(df, df.filter("vec_id IN (1, 20, 103, 106)"), 3).orderBy("query_id", "rank").collect()
    assert [(r["query_id"], r["rank"], r["id"]) for r in got] == [(1, 1, 7), (1, 2, 6), (1, 3, 5), (20, 1, 7), (20, 2, 6), (20, 3, 5)]
    assert got[0]["score"] == 7 + 1 + 0.25
    few = neighbours.nearest(df.filter("vec_id <= 2"), df.filter("vec_id <= 2"), 3).collect()
    assert sorted((r["query_id"], r["id"]) for r in few) == [(1, 2), (2, 1)]
    assert neighbours.nearest(df.filter("false"), df, 3).count() == 0
    assert neighbours.nearest(df, df.filter("false"), 3).count() == 0


def test_neighbour_ties_go_to_the_smaller_id(spark):
    df = vectors(spark, [(i, [0.3, 0.7, 0.1]) for i in range(300)])
    got = neighbours.nearest(df, df.filter("vec_id = 7"), 4).orderBy("rank").collect()
    assert [r["id"] for r in got] == [0, 1, 2, 3]


def test_neighbour_recall(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding").collect()
    ids, v = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], dtype=np.float64)
    got: dict = {}
    for r in op1_neighbours(spark, SF).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
        assert abs(r["score"] - v[ids == r["query_id"]][0] @ v[ids == r["vec_id"]][0]) < 1e-12
    hits = [len(got[q] & set(ids[np.argsort(-np.where(ids == q, -9, v @ v[ids == q][0]))[:20]])) for q in ids[ids % 20 == 0]]
    assert np.mean(hits) / 20 >= 0.9


@pytest.mark.parametrize("blocks", [16, 64])
def test_neighbours_over_many_cells(spark, monkeypatch, blocks):
    monkeypatch.setattr(neighbours, "BLOCK_ROWS", blocks)
    monkeypatch.setattr(neighbours, "QUERY_ROWS", 7)
    v = np.random.default_rng(3).standard_normal((400, 12)) * np.random.default_rng(4).uniform(0.5, 2, (400, 1))
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<double>")
    rows = neighbours.nearest(df, df.filter("vec_id % 20 = 0"), 5).collect()
    got: dict = {}
    for r in rows:
        got.setdefault(r["query_id"], set()).add(r["id"])
    scores = v @ v.T
    np.fill_diagonal(scores, -np.inf)
    assert np.mean([len(got[q] & set(np.argsort(-scores[q])[:5])) for q in range(0, 400, 20)]) >= 4.5


def slow_near(ids, v):
    u = v / np.linalg.norm(v, axis=1)[:, None]
    near = u @ u.T >= 0.95
    np.fill_diagonal(near, False)
    label = groups_of(range(len(ids)), list(zip(*map(list, np.nonzero(near)))))
    low = {}
    for i, x in enumerate(ids):
        low[label[i]] = min(low.get(label[i], x), x)
    return {x: (int(near[i].sum()), low[label[i]]) for i, x in enumerate(ids)}


@pytest.mark.parametrize("part_rows", [40, 2048])
def test_near_vectors_match_brute_force(spark, monkeypatch, part_rows):
    monkeypatch.setattr(flatgraph, "PART_ROWS", part_rows)
    monkeypatch.setattr(flatgraph, "CLUSTER_ROWS", 100)
    rng = np.random.default_rng(8)
    base = rng.standard_normal((300, 16))
    near = np.repeat(base[:40], 4, axis=0) + 0.03 * rng.standard_normal((160, 16))
    hot = base[0] + 0.05 * rng.standard_normal((120, 16))
    v = np.concatenate([base, near, hot, base[50:60], 3 * base[60:65]])
    ids = rng.permutation(len(v)).tolist()
    rows = list(zip(ids, v.astype(np.float64).tolist()))
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {r["id"]: (r["n_links"], r["component"]) for r in flatgraph.near_duplicates(df).collect()}
    want = slow_near(ids, v)
    links = sum(n for n, _ in want.values())
    assert len(got) == len(want) and all(got[i][0] <= want[i][0] for i in ids)
    assert sum(n for n, _ in got.values()) >= 0.98 * links
    assert np.mean([got[i][1] == want[i][1] for i in ids]) >= 0.98


def test_near_vectors_odd_rows(spark):
    rows = [(5, [1.0, 0.0, 0.0]), (2, [2.0, 0.0, 0.0]), (9, [1.0, 0.0, 0.0]), (9, [1.0, 0.0, 0.0]), (4, [0.0, 1.0, 0.0]), *ODD]
    df = vectors(spark, rows)
    got = sorted(map(tuple, flatgraph.near_duplicates(df).collect()), key=str)
    alone = [(4, 0, 4), *((i, 0, i) for i, _ in ODD)]
    assert got == sorted([(5, 3, 2), (2, 3, 2), (9, 3, 2), (9, 3, 2), *alone], key=str)
    assert flatgraph.near_duplicates(df.filter("false")).count() == 0


def test_near_vector_query_covers_all_rows(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    want = slow_near([r["vec_id"] for r in rows], np.array([r["embedding"] for r in rows], dtype=np.float64))
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in op9_flatgraph(spark, SF).collect()}
    assert got == want


def test_similar_agrees_with_the_distance():
    rng = random.Random(6)
    for _ in range(1500):
        a = " ".join("".join(rng.choices("ab", k=rng.randrange(1, 5))) for _ in range(rng.randrange(1, 7)))
        b = "".join(c if rng.random() < 0.85 else rng.choice("ab ") for c in a)
        want = slow_distance(a, b) <= 0.2 * max(len(a), len(b)) + 1e-9
        assert lines.similar(a, b, 0.8) == want, (a, b)


def edited(rng: random.Random, text: str, edits: int, letters: str) -> str:
    out = list(text)
    for _ in range(edits):
        i = rng.randrange(len(out) + 1)
        out[i : i + rng.randrange(2)] = rng.choice(["", rng.choice(letters)])
    return "".join(out)


@pytest.mark.parametrize("least", [0.5, 0.8, 0.95])
def test_lines_compared_in_blocks_are_those_compared_one_by_one(monkeypatch, least):
    rng = random.Random(4)
    pairs = [("", ""), ("", "a"), ("a", ""), ("same", "same"), ("a" * 9000, "a" * 9000 + "b")]
    for n in (1, 5, 63, 64, 65, 127, 128, 129, 200, 400) * 20:
        letters = rng.choice(["ab", "abcdefgh ", "abcé世𝄞 ", "".join(map(chr, range(0x4E00, 0x4F00)))])
        a = "".join(rng.choices(letters, k=n))
        other = edited(rng, a, rng.randrange(1 + n // 2), letters) if rng.random() < 0.7 else "".join(rng.choices("xyz", k=n))
        pairs.append(rng.sample([a, other], 2))
    left, right = zip(*pairs)
    want = [lines.similar(a, b, least) for a, b in pairs]
    assert 20 < sum(want) < len(want) - 20
    monkeypatch.setattr(lines, "BLOCK_PAIRS", 50)
    for places in (lines.PLACES, 1 << 10):
        monkeypatch.setattr(lines, "PLACES", places)
        assert lines.all_similar(left, right, least).tolist() == want
    assert lines.all_similar([], [], least).tolist() == []


@pytest.mark.parametrize("least", [0.6, 0.8, 0.9])
def test_blocks_of_any_lengths_agree_with_the_distance(monkeypatch, least):
    rng, pairs = random.Random(9), []
    for n in (3, 64, 66, 130, 300, 700, 1500) * 40:
        letters = rng.choice(["ab ", "abcdefghij ", "abé世𝄞 "])
        a = "".join(rng.choices(letters, k=n))
        other = edited(rng, a, max(0, round(n * (1 - least) * rng.uniform(0.5, 4))), letters)
        cut = rng.randrange(1 + n // 10)
        pairs.append(rng.sample([a, rng.choice([other, other[cut:], a[cut:] + other[:cut]])], 2))
    left, right = zip(*pairs)
    want = [lines.edit_distance(a, b) <= int((1 - least) * max(len(a), len(b)) + 1e-9) for a, b in pairs]
    assert 20 < sum(want) < len(want) - 20
    monkeypatch.setattr(lines, "PAIRS_A_WORD", 0)
    for alike in (lines.ALIKE, 0):
        monkeypatch.setattr(lines, "ALIKE", alike)
        assert lines.all_similar(left, right, least).tolist() == want


def test_long_lines_are_compared_in_blocks(monkeypatch):
    def alone(*_):
        raise AssertionError("pairs one by one")

    monkeypatch.setattr(lines, "similar", alone)
    monkeypatch.setattr(lines, "edit_distance", alone)
    rng = random.Random(7)
    left = ["".join(rng.choices("abcdefgh ", k=1300)) for _ in range(300)]
    near = [edited(rng, x, 200, "abcdefgh ") for x in left[:50]]
    assert lines.all_similar(left, near + left[:250], 0.8).tolist() == [True] * 50 + [False] * 250


def test_wide_buckets_meet_at_pivots_first(spark, monkeypatch):
    """Near copies whose first item holds with none: some pivots join nearly all, and no pair across final groups is left out."""
    rng = random.Random(6)
    holds = {p for p in combinations(range(1, 120), 2) if rng.random() < 0.4} | {(200, 201)}
    rows = [(7, i) for i in range(120)] + [(8, i) for i in (0, 200, 201)]
    right = spark.createDataFrame(sorted(holds), "p long, q long")
    seen = []

    def verify(pairs):
        seen.append(pairs.count())
        return pairs.join(right, (F.col("a.id") == F.col("p")) & (F.col("b.id") == F.col("q")), "left_semi")

    monkeypatch.setattr(buckets, "WIDE", 64)
    links = bucket_links(spark.createDataFrame(rows, "key long, id long"), None, verify, lambda a, b, key: F.lit(True))
    got = [(r["a"]["id"], r["b"]["id"]) for r in links.collect()]
    assert set(got) <= holds
    assert groups_of([i for i in range(120)] + [200, 201], got) == groups_of([i for i in range(120)] + [200, 201], holds)
    assert sum(seen) < 120 * 119 / 2 / 2


def test_few_kept_ids_shuffle_no_documents(spark):
    docs = spark.createDataFrame([(i, f"text number {i} of its own {i * 7919}") for i in range(50)], "doc_id long, text string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = simhash.keep_one(docs)
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
        assert out.count() == len({r["component"] for r in simhash.simhash_groups(docs).collect()})
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_pairs_of_lines_are_met_at_one_key_of_blocks(spark):
    rng = random.Random(8)
    base = [rng.getrandbits(64) for _ in range(12)]
    sims = [b ^ sum(1 << k for k in rng.sample(range(64), rng.randrange(5))) for b in base for _ in range(5)]
    rows = [(i, int(np.uint64(s).astype(np.int64)), [7], 40) for i, s in enumerate(sims)]
    keyed = lines._keys(spark.createDataFrame(rows, "id long, sim long, runs array<long>, size int"))
    item = F.struct("sim", "id", "size")
    left, right = keyed.select("key", item.alias("x")), keyed.select("key", item.alias("y"))
    near, once = lines._near(), lines._met_once()
    met = left.join(right, "key").filter("x.id < y.id").filter(near(F.col("x"), F.col("y"), F.col("key")))
    kept = met.filter(once(F.col("x"), F.col("y"), F.col("key"))).select("x.id", F.col("y.id").alias("other"))
    every = {tuple(r) for r in met.select("x.id", "y.id").collect()}
    found = [tuple(r) for r in kept.collect()]
    assert len(found) == len(set(found)) and set(found) == every and met.count() > len(found)
