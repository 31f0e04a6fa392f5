"""Divergence rules, spelling variants and conversation repair."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import check
from millrace.llm import conversations, divergence, spelling
from millrace.llm.common import table

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return check.duck(SF)


@pytest.mark.parametrize("name", ["op11_divergence", "op12_spelling", "op13_conversations"])
def test_query_matches_its_sql(spark, con, name):
    ok, note = check.compare(spark, con, name, SF)
    assert ok, note


# Conversations


def first_faults(rows):
    """Faults of ordered ``(turn, role, text)`` rows: '', blank, duplicate or truncated."""
    seen, out = set(), []
    for _, role, text in rows:
        end = text.rstrip(" \t\n\v\f\r")
        fault = "blank" if not end else "duplicate" if (role, text) in seen else "truncated" if end[-1] not in ".!?" else ""
        seen.add((role, text))
        out.append(fault)
    return out


def slow_repair(rows):
    """Every way to edit the rows, at most two inserts at a place: the least cost and letters, and its lines."""
    faults = first_faults(rows)
    inserts = [[], ["user"], ["assistant"], ["user", "assistant"], ["assistant", "user"]]
    best = None

    def options(i):
        _, role, text = rows[i]
        yield 2, "D", None
        if faults[i] not in ("blank", "duplicate"):
            extra = 5 if faults[i] == "truncated" else 0
            yield extra, "K", (role, text)
            for other in ("user", "assistant"):
                yield 1 + extra, "R", (other, text)

    for choice in itertools.product(*(list(options(i)) for i in range(len(rows)))):
        for added in itertools.product(inserts, repeat=len(rows) + 1) if len(rows) < 3 else [()]:
            cost, audit, lines = 0, "", []
            for i in range(len(rows) + 1):
                for role in added[i] if added else []:
                    cost, audit = cost + 5, audit + "I"
                    lines.append((role, ""))
                if i < len(rows):
                    cost, audit = cost + choice[i][0], audit + choice[i][1]
                    lines += [choice[i][2]] if choice[i][2] else []
            if re.fullmatch("(s?(ua)+)?", "".join(role[:1] or "-" for role, _ in lines)):
                found = (cost, audit, "\n".join(f"{r}:{t}" for r, t in lines))
                best = min(best, found) if best else found
    return best


def slow_report(rows):
    """The result for one conversation's rows in any order; nulls are still there."""
    rows = [(t, " " if r is None else r, " " if x is None else x) for t, r, x in rows]
    rows.sort(key=lambda row: (row[0] is not None, row[0] or 0, row[1].encode(), row[2].encode()))
    faults = Counter(first_faults(rows))
    turns = {t for t, _, _ in rows if t is not None}
    pairs = [a[1][:1] + b[1][:1] for a, b in itertools.pairwise(rows)]
    cost, audit, text = slow_repair(rows) if rows else (0, "", "")
    return (
        max(turns) - min(turns) + 1 - len(turns) if turns else 0,
        faults["blank"],
        faults["duplicate"],
        faults["truncated"],
        sum(p not in ("su", "ua", "au") for p in pairs),
        cost,
        audit,
        hashlib.sha256(text.encode()).hexdigest(),
    )


def conversation_rows(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def reports(df):
    return {r["conv_id"]: tuple(r[c] for c in conversations.RESULT) for r in df.collect()}


@pytest.mark.parametrize("bits", [0, 1, 11])
def test_repairs_match_brute_force(spark, monkeypatch, bits):
    """Also where every row, or every second one, is a part of its own."""
    monkeypatch.setattr(conversations, "BLOCK_BITS", bits)
    rng = random.Random(bits)
    texts = ["Yes.", "No!", "cut", "", " \n", None, "Why?", "end. "]
    rows = []
    for conv in range(60):
        for _ in range(rng.randrange(1, 6)):
            role = rng.choice(["system", "user", "assistant", "user", "assistant", "tool", "", None])
            rows.append((conv if conv else None, rng.choice([None, 0, 1, 2, 3, 7]), role, rng.choice(texts)))
    got = reports(conversations.repaired(conversation_rows(spark, rows)))
    want = {}
    for conv, *row in rows:
        want.setdefault(conv, []).append(tuple(row))
    assert got == {conv: slow_report(of) for conv, of in want.items()}


def test_inserts_are_used_where_they_pay(monkeypatch):
    """With the given costs a deletion is always cheaper; with others the same paths insert."""
    monkeypatch.setattr(conversations, "INSERT", 1)
    rows = [("u", conversations.NONE, 1), ("u", conversations.NONE, 1), ("a", conversations.NONE, 1)]
    assert conversations.whole_path([conversations.part_weights(rows)]) == (1, "KIKK")
    parts = [conversations.part_weights([row]) for row in rows]
    assert conversations.whole_path(parts) == (1, "KIKK")


def test_one_long_conversation_is_solved_in_parts(spark, monkeypatch):
    rng = random.Random(5)
    rows = [(9, t, rng.choice(["user", "assistant"]), rng.choice(["a.", "b?", f"{t}!", f"{t}", ""])) for t in range(900)]
    whole = reports(conversations.repaired(conversation_rows(spark, rows)))
    monkeypatch.setattr(conversations, "BLOCK_BITS", 5)
    assert reports(conversations.repaired(conversation_rows(spark, rows))) == whole
    ordered = [(t, r, x) for _, t, r, x in rows]
    kinds = {"": 0, "blank": 1, "duplicate": 2, "truncated": 3}
    alone = conversations.part_weights([(r[:1], kinds[f], 1) for (_, r, _), f in zip(ordered, first_faults(ordered))])
    assert conversations.whole_path([alone]) == whole[9][5:7]


def test_repeated_rows_are_counted_not_carried(spark):
    rows = [(1, 0, "user", "Hi."), (1, 1, "assistant", "Ho.")] + [(1, 1, "assistant", "Ho.")] * 500
    gaps, blank, duplicate, truncated, illegal, cost, audit, _ = reports(conversations.repaired(conversation_rows(spark, rows)))[1]
    assert (gaps, blank, duplicate, truncated, illegal, cost) == (0, 0, 500, 0, 500, 1000)
    assert audit == "KK" + "D" * 500
    kept = conversations.numbered_rows(
        conversation_rows(spark, rows), "conv_id", "turn", "role", "text", F.lit(True)
    )
    assert kept.count() == 2


def test_conversations_without_rows_and_extra_columns(spark):
    rows = conversation_rows(spark, [(1, 0, "user", "Hi."), (2, 0, "user", "Hi.")]).withColumns(
        {"conv": F.lit("x"), "place": F.lit(1), "stays": F.lit(False), "n": F.lit(0), "fault": F.lit("f")}
    )
    got = reports(conversations.repaired(rows, keep=F.col("conv_id") == 1))
    assert got[2] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert got[1][5:7] == (2, "D")
    assert reports(conversations.repaired(rows.limit(0))) == {}


def test_damage_follows_the_checksum(spark):
    rows = [(c, t, "system", "One. Two! Three") for c in range(40) for t in range(5)] + [(None, None, None, None)]
    damaged, stays = conversations.damaged(conversation_rows(spark, rows))
    got = Counter((r["conv_id"], r["turn"], r["role"], r["text"]) for r in damaged.filter(stays).collect())
    want = Counter()
    for conv, turn, role, text in rows:
        name = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        role, text = " " if role is None else role, " " if text is None else text
        mark = zlib.crc32(name.encode()) % 20
        text = {1: "", 2: re.sub("[.!?]", "", text)}.get(mark, text)
        want[conv, turn, "user" if mark == 4 else role, text] += {0: 0, 3: 2}.get(mark, 1)
    assert got == +want


# Spelling


def one_edit(a: str, b: str) -> bool:
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    a, b = sorted((a, b), key=len)
    i = next((i for i in range(len(a)) if a[i] != b[i]), len(a))
    return a[i + 1 :] == b[i + 1 :] if len(a) == len(b) else a[i:] == b[i + 1 :]


def slow_variants(counts: dict[str, int], ratio=10):
    near = {w: [o for o in counts if one_edit(w, o)] for w in counts}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-counts[o], o.encode()), default=None)
        form[w] = best if best is not None and counts[best] >= ratio * counts[w] else None
    out = {}
    for w in counts:
        root = w
        while form[root]:
            root = form[root]
        out[w] = (form[w], root, counts[w], len(near[w]), counts[form[w]] if form[w] else None)
    return out


def variants_of(spark, counts):
    rows = spark.createDataFrame(list(counts.items()), "word string, n long")
    return {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in spelling.variants(rows).collect()}


def test_variants_match_brute_force(spark):
    rng = random.Random(2)
    words = set()
    while len(words) < 900:
        word = "".join(rng.choices("abcé", k=rng.randrange(1, 9)))
        words |= {word, word + rng.choice("ab"), word[::-1], word[1:]} - {""}
    counts = {w: rng.choice([2, 3, 30, 300, 3000, 40_000]) for w in words}
    assert variants_of(spark, counts) == slow_variants(counts)


def test_every_pair_within_distance_two_shares_a_signature():
    rng = random.Random(8)
    for _ in range(300):
        word = "".join(rng.choices("abcdefghijklmnopqrstuvwxyzéß", k=rng.randrange(1, 40)))
        i, letter = rng.randrange(len(word)), rng.choice("aeé")
        others = [word[:i] + word[i + 1 :], word[:i] + letter + word[i:], word[:i] + letter + word[i + 1 :]]
        masks, keys = spelling.signatures(["".join(sorted(w)) for w in [word, *others]])
        for row in range(1, 4):
            assert set(keys[0]) & set(keys[row])
            assert int(masks[0] ^ masks[row]).bit_count() <= 2


def test_chains_of_forms_end_at_their_root(spark):
    words = ["a" * 20 + "b" * i for i in range(15)]
    counts = {w: 2 * 10**i for i, w in enumerate(words)}
    got = variants_of(spark, counts)
    assert {g[1] for g in got.values()} == {words[-1]} and got[words[0]][0] == words[1]


def test_signatures_are_not_broadcast(spark, plan):
    classes = spark.createDataFrame([("abcdefg", 7, 1), ("abcdef", 6, 2)], "letters string, size int, words long")
    near = spelling.near_vectors(spelling.Scratch(spark, "classes").keep(classes))
    assert "SortMergeJoin [key#" in plan(near)
    assert [tuple(r) for r in near.collect()] == [("abcdefg", "abcdef")]


def test_no_table_of_words_goes_through_the_driver(spark, monkeypatch):
    plans = []

    def kept(self, df, keep=spelling.Scratch.keep):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return keep(self, df)

    monkeypatch.setattr(spelling.Scratch, "keep", kept)
    rows = spark.createDataFrame([("abcdefg", 50), ("abcdef", 2), ("bcdefg", 2)], "word string, n long")
    found = spelling.variants(rows)
    plans.append(found._jdf.queryExecution().executedPlan().toString())
    assert found.filter("form = 'abcdefg'").count() == 2
    assert sum("SortMergeJoin" in p for p in plans) >= 5 and not any("Broadcast" in p for p in plans)


def test_ties_go_to_the_smallest_word_and_long_words_count(spark):
    long = "xy" * 30_000
    counts = {"aaaaaab": 20, "aaaaaac": 20, "aaaaaa": 2, "ébcdefg": 5, long: 100, long + "z": 2}
    got = variants_of(spark, counts)
    assert got == slow_variants(counts)
    assert got["aaaaaa"][0] == "aaaaaab" and got[long + "z"][1] == long


def test_anagrams_are_no_neighbours(spark):
    counts = {"".join(p): 2 for p in itertools.permutations("abcdef")}
    assert variants_of(spark, counts) == slow_variants(counts)


ODD = [(1, None), (2, ""), (3, " \n"), (4, "Wörter wörter WORDS×÷words " * 5000), (5, "again and again"), (5, "again and again"), (None, "nameless nameless")]


def test_words_of_odd_texts(spark):
    docs = spark.createDataFrame([(*r, "w", 1) for r in ODD], "doc_id long, text string, word string, n int")
    got = {r["word"]: r["n"] for r in spelling.word_counts(docs, min_length=5).collect()}
    assert got == {"wörter": 10_000, "words×÷words": 5000, "again": 4, "nameless": 2}
    assert spelling.variants(spelling.word_counts(docs.limit(0))).count() == 0


def test_slips_follow_the_checksum(spark):
    docs = [(r["doc_id"], r["text"]) for r in table(spark, SF, "documents").collect()]
    want = Counter()
    for doc, text in docs:
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for run in re.findall("[A-Za-zÀ-ÿ]+", lower):
            h = zlib.crc32(f"{doc}:{run}".encode())
            run = run if h % 31 else run[: h % len(run)] + run[h % len(run) + 1 :]
            want[run] += len(run) >= 7
    got = spelling.word_counts(table(spark, SF, "documents"), slips=31)
    assert {r["word"]: r["n"] for r in got.collect()} == +want


def test_small_tasks_hand_counts_on(spark, monkeypatch):
    monkeypatch.setattr(spelling, "COUNTED_AT_ONCE", 3)
    docs = spark.createDataFrame([(i, "singular plurals singular mixtures") for i in range(50)], "doc_id long, text string")
    assert {r["word"]: r["n"] for r in spelling.word_counts(docs).collect()} == {"singular": 100, "plurals": 50, "mixtures": 50}


# Divergence


def slow_rules(text: str | None):
    text = text or ""
    words = re.findall("[^\x20\x09-\x0d]+", text)
    runs = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = {j for i in range(len(words) - 7) if runs[tuple(words[i : i + 8])] > 1 for j in range(i, i + 8)}
    seen, again = set(), 0
    for line in text.split("\n"):
        if re.search("[^\x20\x09-\x0d]", line):
            again += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall("[#*$%&|<>]", text)), again, len(covered)


def test_rules_match_brute_force():
    rng = random.Random(7)
    texts = [None, "", "\x1c\x85\xa0 a b", "x" * 50_000, "a b c d e f g h " * 300, "é\n\né\n é\n" * 4]
    for _ in range(300):
        k = rng.randrange(60)
        texts.append("".join(rng.choices(["a", "b", "é ", " ", "\n", "a ", "b ", "中", "#", "\t", "|", "\x0b", "\xa0"], k=k)))
        texts.append(" ".join(rng.choices("ab", k=k)))
    for text in texts:
        found = divergence.measured(text)
        got = (len(found.words), found.word_chars, found.n_symbols, found.n_dup_lines, found.n_repeat_words)
        assert got == slow_rules(text), repr(text)


def test_classes_count_every_character_once():
    text = "aZ0 \n\t.#éß中\U0001f600\x00\x7f"
    assert divergence.measured(text).classes.tolist() == [1, 1, 1, 2, 1, 1, 3, 4]


def test_distance_is_that_of_jensen_and_shannon():
    assert divergence.distance(np.array([5, 0]), np.array([0, 9])) == 1
    assert divergence.distance(np.array([1, 3]), np.array([10, 30])) == pytest.approx(0, abs=1e-7)
    p, q = np.array([0.5, 0.5]), np.array([0.9, 0.1])
    m = (p + q) / 2
    want = ((p * np.log2(p / m)).sum() + (q * np.log2(q / m)).sum()) / 2
    assert divergence.distance(np.array([10, 10]), np.array([90, 10])) == pytest.approx(want**0.5)
    assert divergence.distance(np.array([0, 0]), np.array([1, 1])) == 1


ENGLISH = "the cat sat on the mat and the dog lay by the door of the old house in the town "


def english(rng, n):
    return " ".join(rng.choice(ENGLISH.split()) + rng.choice(["", "", "", ",", "."]) for _ in range(n))


def test_junk_goes_and_clean_text_stays(spark):
    rng = random.Random(1)
    clean = [(i, english(rng, 120), "en") for i in range(60)]
    junk = [
        (100, "".join(rng.choices("#$%&* 0123456789", k=2000)), "en"),
        (101, " ".join(f"{w}***" for w in english(rng, 200).split()), "en"),
        (102, " ".join("".join(rng.choices("bcdfgh", k=6)) for _ in range(200)), "en"),
        (103, english(rng, 200).upper(), None),
    ]
    fair = [(200, english(rng, 150), None), (201, "".join(rng.choices("#$%& 0123", k=2000)), "xx")]
    docs = spark.createDataFrame(clean + junk + fair, "doc_id long, text string, lang string")
    got = {r["doc_id"]: (r["base_failed"], r["kept"]) for r in divergence.judged(docs).collect()}
    assert all(got[i] == (False, True) for i in range(60))
    assert all(got[i] == (False, False) for i in (100, 101, 102, 103)), got
    assert got[200] == (False, True)
    # Too few words of that language to say what it looks like.
    known = divergence.references(docs.filter("lang = 'en'"))
    assert {r["kept"] for r in divergence.judged(docs.filter("doc_id = 201"), known).collect()} == {True}


def test_labelled_documents(spark):
    sf = "/root/testdata/sf0.01"
    verdicts = divergence.judged(table(spark, sf, "documents")).join(table(spark, sf, "labels"), "doc_id")
    rows = verdicts.filter("NOT base_failed").collect()
    good = [r["kept"] for r in rows if r["quality"] == 1]
    bad = [r["kept"] for r in rows if r["quality"] == 0]
    assert sum(good) >= 0.99 * len(good) and sum(bad) <= 0.1 * len(bad)


def test_divergence_odd_rows(spark):
    rows = [(*r, "en", 1, True) for r in ODD]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, n_words int, kept boolean")
    got = sorted((r["doc_id"] or 0, r["n_words"], r["base_failed"], r["kept"]) for r in divergence.judged(docs).collect())
    assert got == [(0, 2, True, False), (1, 0, True, False), (2, 0, True, False), (3, 0, True, False), (4, 15000, True, False), (5, 3, True, False), (5, 3, True, False)]
    assert divergence.judged(docs.limit(0)).count() == 0
    assert divergence.references(docs.limit(0)) == {}
