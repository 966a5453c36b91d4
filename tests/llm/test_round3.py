"""op11 to op13 against plain versions: all edits, all pairs, all scores; nulls, ties, repeats, clashing names, empty tables."""

import hashlib
import itertools
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from reelhouse.llm import dualtree, queries, repair, setjoin


@pytest.fixture(scope="module", autouse=True)
def package_on_workers(spark):
    import os
    spark.sparkContext.environment["PYTHONPATH"] = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


# --- op11 -----------------------------------------------------------------------------------

def plain_repair(rows):
    """(cost, audit) by relaxing all edits of (role, must go, truncated) until nothing changes."""
    step = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}
    best = {0: (0, "")}

    def insert(at):
        for _ in range(4):
            for s, (c, a) in list(at.items()):
                for letter, t in step[s].items():
                    if letter != "s" and (c + 5, a + "I") < at.get(t, (math.inf, "")):
                        at[t] = (c + 5, a + "I")
        return at

    for role, gone, cut in rows:
        after = {}
        for s, (c, a) in insert(best).items():
            options = [(c + 2, a + "D", s)]
            if not gone:
                options += [(c + 5 * cut, a + "K", t) for letter, t in step[s].items() if letter == role[:1]]
                options += [(c + 1 + 5 * cut, a + "R", t) for letter, t in step[s].items() if letter != "s"]
            for cost, audit, t in options:
                after[t] = min(after.get(t, (math.inf, "")), (cost, audit))
        best = after
    return min(v for s, v in insert(best).items() if s in (0, 3))


@pytest.mark.parametrize("seed", range(4))
def test_bidirectional_search_against_all_edits(seed):
    rng = random.Random(seed)
    for _ in range(400):
        rows = [(rng.choice(["user", "assistant", "system", "tool", "", "u2"]), rng.random() < 0.15, rng.random() < 0.25) for _ in range(rng.randint(0, 9))]
        got = repair.cheapest(repair._edges([(r, 1, g, c) for r, g, c in rows]), 0, repair.ENDS)
        assert got[:2] == plain_repair(rows), rows
        state, initials = 0, "".join(r[:1] for _, r, _ in repair.edited([(r, "", 1) for r, _, _ in rows], got[1], 0))
        assert re.fullmatch("(s?(ua)+)?", initials) and got[2] == (3 if initials else state)


def plain_conversations(rows):
    """Everything that op11 returns, from (conv, turn, role, text)."""
    out, of = {}, {}
    for conv, turn, role, text in rows:
        of.setdefault(conv, []).append((turn is not None, turn, " " if role is None else role, " " if text is None else text))
    for conv, own in of.items():
        own.sort()
        seen, faults, lattice = set(), Counter(), []
        for _, _, role, text in own:
            last = re.findall(r"[^\x20\x09-\x0D]", text)
            fault = "blank" if not last else "duplicate" if (role, text) in seen else "truncated" if last[-1] not in ".!?" else ""
            seen.add((role, text))
            faults[fault] += 1
            lattice.append((role, fault in ("blank", "duplicate"), fault == "truncated"))
        cost, audit = plain_repair(lattice)
        turns, left, k = [], iter(own), 0
        for edit in audit:
            row = None if edit == "I" else next(left)
            if edit == "D":
                continue
            letter = row[2][:1] if edit == "K" else "ua"[k % 2]
            k += letter != "s"
            turns.append((row[2] if edit == "K" else {"u": "user", "a": "assistant"}[letter]) + ":" + (row[3] if row else ""))
        known = [t for _, t, _, _ in own if t is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(own))
        out[conv] = (gaps, faults["blank"], faults["duplicate"], faults["truncated"], illegal, cost, audit, hashlib.sha256("\n".join(turns).encode()).hexdigest())
    return out


def repaired_all(spark, rows, segment, partitions):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("cost", F.lit("x")).repartition(partitions)
    parts = repair.segments(df, segment)
    chosen = repair.decisions(parts)
    found = {r.conv_id: tuple(r)[1:] for r in repair.summaries(parts, chosen).collect()}
    texts = {r.conv_id: r.repaired_sha256 for r in repair.digests(repair.repaired(parts, chosen)).collect()}
    assert found.keys() == texts.keys()
    return {k: (*v, texts[k]) for k, v in found.items()}


@pytest.mark.parametrize("segment", [2, 5, 256])
def test_repair_of_conversations_against_a_plain_version(spark, segment):
    rng = random.Random(segment)
    texts = ["Yes.", "No!", "why", "", " ", "\t\n", "a b?", "end. ", None, "x" * 3000 + "."]
    rows = []
    for conv in [*range(40), None]:
        for turn in range(rng.randint(1, 9) if conv != 7 else 160):          # one conversation over many segments and tasks
            if rng.random() < 0.1:
                continue
            row = (conv, None if rng.random() < 0.05 else turn, rng.choice(["user", "assistant", "user", "assistant", "system", None, ""]), rng.choice(texts) if conv != 7 or turn % 3 else f"t{turn}.")
            rows += [row] * (3 if rng.random() < 0.1 else 1)
    assert repaired_all(spark, rows, segment, 7) == plain_conversations(rows)


def test_repair_of_a_row_that_a_conversation_repeats_many_times(spark):
    rows = [(1, 0, "user", "Hi.")] * 5000 + [(1, 1, "assistant", "Ho.")]
    assert repaired_all(spark, rows, 16, 4) == plain_conversations(rows)


def test_repair_of_an_empty_table(spark):
    assert repaired_all(spark, [], 16, 2) == {}


def test_repair_query_keeps_conversations_that_lose_all_rows(spark, tmp_path):
    import zlib
    gone = next(i for i in range(100, 900) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    rows = [(gone, 0, "user", "Hi."), (None, None, None, None), (3, None, "user", "a."), (3, 2, "assistant", "b.")]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    got = {r.conv_id: tuple(r)[1:] for r in queries.op11_structure_repair(spark, str(tmp_path)).collect()}
    assert got[gone] == (0,) * 6 + ("", hashlib.sha256(b"").hexdigest()) and set(got) == {gone, None, 3}


# --- op12 -----------------------------------------------------------------------------------

def plain_search(docs, items, k):
    cut = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")

    def low(t):
        return [w.encode().lower() for w in cut.findall(t or "")]

    held = [(i, len(w), Counter(w)) for i, t in docs if (w := low(t))]
    n_docs, n_terms = len(held), sum(n for _, n, _ in held)
    df = Counter(t for _, _, c in held for t in c)
    wanted, out = {}, []
    for item, t in items:
        wanted.setdefault(item, set()).update(low(t))
    for item, terms in wanted.items():
        scored = []
        for i, n, c in held:
            m = 100 - 50 + ((50 * n * n_docs) // n_terms)
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[x] + 1))) * ((10**9 * c[x]) // (1000 * c[x] + 20 * m)) for x in terms if x in c)
            if s > 0:
                scored.append((-s, i is not None, i))
        out += [(item, r + 1, i, -s) for r, (s, _, i) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=str)


@pytest.mark.parametrize(("block", "k"), [(1 << 17, 50), (40, 3)])
def test_dual_tree_search_against_all_scores(spark, block, k):
    rng = random.Random(k)
    words = [f"w{i}" for i in range(300)] + ["Été", "naïve", "東京", "A1"]
    texts = [" ".join(rng.choice(words[: rng.choice([5, 40, 304])]) for _ in range(rng.randint(1, 120))) for _ in range(700)]
    texts += [texts[3]] * 60 + [None, "", "!!! ---", "W1 w1,W1\x00w1", "été ÉTÉ", "x" * 200_000]          # ties, odd texts
    docs = [(None if i == 9 else 5 if i in (11, 12) else i, t) for i, t in enumerate(texts)]
    items = [(j, " ".join(rng.choice(words) for _ in range(rng.randint(1, 30)))) for j in range(25)]
    items += [(2, "w9 w10"), (None, "w7"), (90, None), (91, "?"), (92, "never seen"), (93, texts[3]), (94, "W1 Été ÉTÉ")]
    got = dualtree.search(spark.createDataFrame(docs, "doc_id long, text string").withColumn("score", F.lit(1)).repartition(5),
                          spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit(1)), k, block=block).collect()
    assert sorted(map(tuple, got), key=str) == plain_search(docs, items, k)


def test_dual_tree_search_prunes_batches_and_not_results():
    import pyarrow as pa
    rng = np.random.default_rng(2)
    held = [np.sort(rng.choice(60, 6, replace=False)) + 60 * (i % 4) for i in range(40)]
    grid = np.zeros((240, 2048), np.int64)
    for d in range(2048):                              # documents of four themes, neighbours alike, as `_searched` orders them
        theme = d // 512
        grid[60 * theme + rng.choice(60, 20, replace=False), d] = rng.integers(1, 1000, 20)
    best, ids = dualtree.Best(len(held), 5), pa.array(range(2048))
    scored = sum(dualtree.visit(dualtree.item_tree(held), dualtree._levels(grid), ids, best) for _ in range(1))
    assert scored < 40 * 2048 / 3
    for i, terms in enumerate(held):
        scores = grid[terms].sum(axis=0)
        assert [(-s, d) for s, _, d in best.top(i)] == [(scores[d], d) for d in sorted(range(2048), key=lambda d: (-scores[d], d))[:5] if scores[d]]


def test_dual_tree_search_of_empty_tables(spark):
    docs, items = spark.createDataFrame([(1, "a b")], "doc_id long, text string"), spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert dualtree.search(docs.limit(0), items).count() == 0 == dualtree.search(docs, items.limit(0)).count()
    assert [tuple(r)[:3] for r in dualtree.search(docs, items).collect()] == [(1, 1, 1)]


# --- op13 -----------------------------------------------------------------------------------

def plain_groups(rows, words=5, least=80):
    """Smallest id of each row's component, all pairs compared."""
    sets = []
    for _, t in rows:
        found = (t or "").encode().lower().split()
        n = min(words, len(found))
        sets.append({b" ".join(found[i:i + n]) for i in range(len(found) - n + 1)} if found else set())
    group = list(range(len(rows)))
    for i, j in itertools.combinations(range(len(rows)), 2):
        both = len(sets[i] & sets[j])
        if both and 100 * both >= least * (len(sets[i]) + len(sets[j]) - both) and group[i] != group[j]:
            a, b = group[i], group[j]
            group = [a if g == b else g for g in group]
    of = {}
    for g, (i, _) in zip(group, rows, strict=True):
        of.setdefault(g, []).append(i)
    return sorted(((i, len(s), min((x for x in of[g] if x is not None), default=None)) for (i, _), s, g in zip(rows, sets, group, strict=True)), key=str)


def near_texts(seed, n=260):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    shared = [rng.choice(words) for _ in range(30)]
    out = []
    for i in range(n):
        if out and rng.random() < 0.5:                   # a copy with some changed words, of a copy perhaps
            w = rng.choice(out[-12:]).split()
            for _ in range(rng.choice([0, 1, 1, 2, 3, 6])):
                if w:
                    w[rng.randrange(len(w))] = rng.choice(words)
        else:
            w = [rng.choice(words) for _ in range(rng.choice([1, 3, 5, 6, 20, 60, 150]))]
            if rng.random() < 0.4:
                w[len(w) // 2:len(w) // 2] = shared
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize(("seed", "least"), [(1, 80), (2, 80), (3, 55), (4, 95)])
def test_set_join_against_all_pairs(spark, seed, least):
    rows = list(enumerate(near_texts(seed)))
    rows += [(1000, None), (1001, ""), (1002, " \t"), (1003, "W1 w2"), (1004, "w1  W2"), (1005, "w1"), (None, rows[0][1]), (None, "lonely"), (7, "other text of an id"), (7, rows[7][1])]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n", F.lit("x")).repartition(6)
    got = setjoin.near_duplicates(df, 5, least).collect()
    assert sorted(map(tuple, got), key=str) == plain_groups(rows, least=least)


def test_set_join_signatures_never_rule_out_a_link(spark):
    rng = np.random.default_rng(5)
    for _ in range(200):
        both, a, b = (rng.integers(0, 1 << 63, n).astype(np.uint64) for n in (rng.integers(1, 900), rng.integers(0, 60), rng.integers(0, 60)))
        x, y = np.union1d(both, a), np.union1d(both, b)
        differ = int(np.bitwise_count((setjoin.signature(x) ^ setjoin.signature(y)).view(np.uint64)).sum())
        assert differ <= len(np.setxor1d(x, y))


def test_set_join_of_a_large_group_of_near_copies(spark):
    rng = random.Random(6)
    base = [f"b{i}" for i in range(200)]
    rows = [(i, " ".join(f"c{i}" if k == rng.randrange(200) else w for k, w in enumerate(base))) for i in range(600)]
    rows += [(5000 + i, " ".join([*base[:100], *(f"z{i}_{k}" for k in range(100))])) for i in range(50)]          # half of it: no link
    got = setjoin.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    want = plain_groups(rows)
    assert sorted(map(tuple, got), key=str) == want
    assert max(Counter(least for _, _, least in want).values()) > 500


def test_set_join_of_an_empty_table_and_a_long_text(spark):
    df = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    assert setjoin.near_duplicates(df.limit(0)).count() == 0
    long = " ".join(f"w{i}" for i in range(150_000))
    got = setjoin.near_duplicates(spark.createDataFrame([(1, long), (2, long + " more"), (3, "x")], "doc_id long, text string")).collect()
    assert sorted(map(tuple, got)) == [(1, 149_996, 1), (2, 149_997, 1), (3, 1, 3)]
