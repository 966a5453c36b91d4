"""Each operator against a brute-force version, and on nulls, empties, ties, repeats, clashing names and empty tables."""

import base64
import hashlib
import io
import itertools
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from reelhouse.llm import bpe, chat, components, exact_dedup, langid, packing, quality, queries, simhash, spotsigs, tokencount, warc
from reelhouse.llm.common import sampled_ids, stage

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
RANKS = "byte_bpe_multi_50k.tiktoken"
SF = "/root/testdata/sf0.001"

ODD = [None, "", " ", "\t\n", "a", "A b", "a  b", "a\tb", "!!!", "été für naïve 東京 \U0001f600", "x" * 5000, "the " * 3000,
       "Tab\x1cfs\x85nel\xa0nbsp em", "  lead and trail  \n\n", "▁mark ▁▁ x", "<s> </s> <|endoftext|>", "\x00\x01 null", "1234567 89 's 'll don't"]


@pytest.fixture(scope="module", autouse=True)
def package_on_workers(spark):
    import os
    spark.sparkContext.environment["PYTHONPATH"] = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def docs(spark, texts, ids=None):
    ids = range(len(texts)) if ids is None else ids
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in zip(ids, texts, strict=True)], DOCS)


def some_texts(n=300, seed=3):
    rng = random.Random(seed)
    words = [w for w in "the of a and in to is on for was with by der die und le la les de el los que y river stone quick brown cloud Grün maison perro".split()]
    words += ["".join(rng.choice("abcdefgéß") for _ in range(rng.randint(2, 9))) for _ in range(400)]
    out = [" ".join(rng.choice(words) for _ in range(rng.randint(1, 200))) for _ in range(n)]
    for i in range(0, n, 5):          # near copies, and copies of near copies
        w = out[i].split()
        for j in range(i + 1, min(n, i + 4)):
            w = list(w)
            w[rng.randrange(len(w))] = rng.choice(words)
            out[j] = " ".join(w)
    return out


def closed(links, nodes):
    """Smallest member of each node's component."""
    parent = {n: n for n in nodes}

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a
    for a, b in links:
        a, b = find(a), find(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


# --- op1 ------------------------------------------------------------------------------------

def test_exact_dedup_decisions(spark):
    texts = ODD + ["a b", "a\x0bb", None, "a"] + ["copy"] * 700
    got = {r.doc_id: r for r in exact_dedup.decisions(docs(spark, texts), exact_dedup.new_index(spark, 8)).collect()}
    norm = [re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for t in texts]
    for i, t in enumerate(norm):
        same = [j for j, u in enumerate(norm) if u == t]
        assert (got[i].keep_id, got[i].group_size, got[i].kept) == (same[0], len(same), i == same[0])
        assert got[i].text_sha256 == hashlib.sha256(t.encode()).hexdigest()


def test_exact_dedup_index_persists_and_appends(spark):
    index = exact_dedup.new_index(spark, 8)
    path = index.path.rsplit("/", 1)[0]
    assert exact_dedup.decisions(docs(spark, ["x", "y"]), index).filter("kept").count() == 2
    again = exact_dedup.DigestIndex(spark, path, 8)
    second = {r.doc_id: (r.keep_id, r.kept) for r in exact_dedup.decisions(docs(spark, ["y", "z", "z"], [10, 11, 12]), again).collect()}
    assert second == {10: (1, False), 11: (11, True), 12: (11, False)}
    assert again.read().count() == 3
    assert exact_dedup.decisions(docs(spark, ["x", "y"]), again).filter("kept").count() == 0     # ingested again: nothing new
    assert again.read().count() == 3
    assert exact_dedup.decisions(docs(spark, []), again).count() == 0


def test_exact_dedup_index_keeps_its_buckets_when_reopened_with_another_count(spark):
    index = exact_dedup.new_index(spark, 8)
    exact_dedup.decisions(docs(spark, ["x", "y"]), index).count()
    again = exact_dedup.DigestIndex(spark, index.path.rsplit("/", 1)[0], 16)
    second = {r.doc_id: r.kept for r in exact_dedup.decisions(docs(spark, ["y", "z"], [10, 11]), again).collect()}
    assert again.buckets == 8 and second == {10: False, 11: True} and again.read().count() == 3


def test_exact_dedup_anti_join_reads_the_index_by_bucket(spark):
    index = exact_dedup.new_index(spark, 8)
    exact_dedup.decisions(docs(spark, ["x", "y"]), index)
    keys = exact_dedup.numbered(docs(spark, ["x", "q"])).groupBy("digest").count().repartition(8, "digest")
    plan = keys.join(index.read().hint("merge"), "digest", "left_anti")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Bucketed: true" in plan.replace("SelectedBucketsCount", "")
    below_index = plan[plan.index("Bucketed: true") - 400: plan.index("Bucketed: true")]
    assert "Exchange" not in below_index


def test_exact_dedup_keeps_one_of_repeated_rows_and_all_columns(spark):
    df = spark.createDataFrame([(1, "t", "r", "d"), (1, "t", "r", "d"), (None, "t", "x", "y"), (None, "u", "k", "l"), (None, "u", "k", "l")],
                               "doc_id long, text string, row string, digest string")
    got = exact_dedup.deduplicate(df, exact_dedup.new_index(spark, 4))
    assert got.columns == df.columns
    assert sorted(map(tuple, got.collect()), key=str) == [(1, "t", "r", "d"), (None, "u", "k", "l")]


# --- op2 ------------------------------------------------------------------------------------

def test_quality_held_out(spark):
    df, lab = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    got = queries.op2_quality_classifier(spark, "/root/testdata/sf0.01")
    assert got.count() == df.count()
    rows = got.join(lab, "doc_id").filter("held_out").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    good, bad = [r.score for r in rows if r.quality == 1], [r.score for r in rows if r.quality == 0]
    auc = np.mean([(g > b) + 0.5 * (g == b) for g in good for b in bad])
    assert auc > 0.93
    assert np.mean([r.predicted for r in rows if r.quality == 1]) > 0.95
    assert got.filter("score IS NULL OR score < 0 OR score > 1").count() == 0


def test_quality_edges(spark):
    model = quality.train(docs(spark, []), spark.createDataFrame([], "doc_id long, quality int"))
    scored = quality.score(docs(spark, ODD), model)
    assert {r.score for r in scored.collect()} == {0.5}
    texts = [f"good words here {i} and more of them" for i in range(60)] + [f"BAD!! {i} ###" * 5 for i in range(60)]
    lab = spark.createDataFrame([(i, int(i < 60)) for i in range(120)] + [(3, None), (4, 7), (5, 1), (None, 1)], "doc_id long, quality int")
    model = quality.train(docs(spark, texts), lab)
    got = [r.score for r in quality.score(docs(spark, [*texts, None, ""]), model).orderBy("doc_id").collect()]
    assert min(got[:60]) > max(got[60:120]) and got[-1] == got[-2] and 0 <= got[-1] <= 1


def labelled_texts(n=60):
    return [f"good words here {i} and more of them" for i in range(n)] + [f"BAD!! {i} ###" * 5 for i in range(n)]


def test_quality_one_very_long_text_leaves_the_others_in(spark):
    texts = labelled_texts()
    rows = spark.createDataFrame([(i, int(i < 60)) for i in range(120)], "doc_id long, quality int")
    first = {r.quality: r.doc_id for r in sampled_ids(rows, "quality", "doc_id", 60).filter("rank = 1").collect()}
    for y, i in first.items():
        plain = list(texts)
        plain[i] = texts[i] * (5_000_000 // len(texts[i]) + 1)
        sample, counts = quality.sample_labelled(docs(spark, plain), rows, F.lit(True), "doc_id", "text", "quality", 60, 4 << 20)
        got = {r["_id"]: r for r in sample.collect()}
        assert len(got) == 120 and counts == {0: 60, 1: 60}
        assert 3_900_000 < len(got[i]["_text"]) <= 4 << 20 and got[i]["_n"] == len(plain[i])
        assert all(got[j]["_text"] == t for j, t in enumerate(plain) if j != i)
        scores = [r.score for r in quality.score(docs(spark, texts), quality.train(docs(spark, plain), rows)).orderBy("doc_id").collect()]
        assert min(scores[:60]) > max(scores[60:]), y
    assert quality.common_length([10, 20, 900, 1000], 400) == 185 and quality.common_length([10, 20], 400) == 20


def test_quality_learns_nothing_from_held_out_or_foreign_labels(spark):
    df, held_out = docs(spark, labelled_texts()), queries.fold("doc_id", 5) == 0
    lab = spark.createDataFrame([(i, int(i < 60)) for i in range(120)], "doc_id long, quality int")
    flipped = lab.withColumn("quality", F.when(held_out, F.lit(1)).otherwise(F.col("quality")))
    more = flipped.unionAll(lab.filter("doc_id < 7")).unionAll(spark.range(500, 900).selectExpr("id AS doc_id", "1 AS quality"))
    assert quality.train(df, lab, ~held_out) == quality.train(df, more, ~held_out)


@pytest.mark.parametrize("good", [1, 2, 7, 8])
def test_quality_learns_from_however_few_labels(spark, good):
    rng = random.Random(good)
    clean = [" ".join(rng.choice("river stone quiet morning market letter garden window".split()) for _ in range(120)) for _ in range(good)]
    junk = ["".join(rng.choice("#$%&=+<>{}0123456789") for _ in range(600)) for _ in range(200)]
    rows = clean + junk
    model = quality.train(docs(spark, rows), spark.createDataFrame([(i, int(i < good)) for i in range(len(rows))], "doc_id long, quality int"))
    fresh = [" ".join(rng.choice("river stone quiet morning market letter garden window".split()) for _ in range(120)) for _ in range(20)]
    bad = ["".join(rng.choice("#$%&=+<>{}0123456789") for _ in range(600)) for _ in range(20)]
    scores = [r.score for r in quality.score(docs(spark, fresh + bad), model).orderBy("doc_id").collect()]
    assert min(scores[:20]) > max(scores[20:])


def test_quality_dictionary_of_uniform_texts_takes_passages_of_all(spark):
    """Texts that no dictionary can be trained on: later ones take part as the first do."""
    texts = [c * 3000 for c in "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"] * 2
    lab = spark.createDataFrame([(i, int(i < 52)) for i in range(104)], "doc_id long, quality int")
    model = quality.train(docs(spark, texts), lab)
    assert all(r.score == r.score for r in quality.score(docs(spark, texts + [None, ""]), model).collect())


def plain_quality(model, text):
    import math

    import zstandard as z
    data = (text or "").encode()
    pieces = [data[i:i + quality.PIECE_BYTES] for i in range(0, len(data), quality.PIECE_BYTES)]
    size = {}
    for kind, d in (("good", model.good), ("bad", model.bad)):
        press = z.ZstdCompressor(level=quality.LEVEL, dict_data=z.ZstdCompressionDict(d), write_content_size=False, write_dict_id=False)
        size[kind] = sum(len(press.compress(p)) for p in pieces)
    difference, length = 10 * (size["bad"] - size["good"]) / max(len(data), 1), math.log1p(len(data))
    at = sum(w * x for w, x in zip(model.weights, (1, difference, length, difference * length), strict=True))
    return 1 / (1 + math.exp(-min(30, max(-30, at))))


def test_quality_against_a_plain_scorer_on_all_rows(spark):
    table, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{x}.parquet") for x in ("documents", "labels"))
    model = quality.train(table, labels, queries.fold("doc_id", 5) != 0)
    for r in quality.score(table.unionByName(docs(spark, ODD, range(10**6, 10**6 + len(ODD)))), model).collect():
        assert r.score == pytest.approx(plain_quality(model, r.text), abs=1e-9)


# --- op3 ------------------------------------------------------------------------------------

def spot_sets(spark, texts):
    """Chains by plain loops; names instead of hashes, but for the words that a hash picks."""
    anchors, out = set(spotsigs.ANCHORS), []
    cut = [[w for w in re.sub(r"[\W_]+", " ", (t or "").lower()).split(" ") if w] for t in texts]
    every = sorted({w for words in cut for w in words})
    hashes = dict(zip(every, (r.h for r in spark.createDataFrame(list(enumerate(every)), "i long, w string").orderBy("i").select(F.hash("w").alias("h")).collect()), strict=True))
    for t, words in zip(texts, cut, strict=True):
        chains, spoken = set(), [w for w in words if w not in anchors]
        for i, w in enumerate(words):
            if w in anchors and (i + 1 == len(words) or words[i + 1] not in anchors):
                content = [x for x in words[i + 1:] if x not in anchors][: spotsigs.CHAIN]
                if len(content) == spotsigs.CHAIN:
                    chains.add((w, *content))
        follow = [(hashes[spoken[i]], tuple(spoken[i:i + spotsigs.CHAIN + 1])) for i in range(len(spoken) - spotsigs.CHAIN)]
        chains |= {c for h, c in follow if h % spotsigs.PICK == 0}
        if follow:
            low = min(h for h, _ in follow)
            least = {c for h, c in follow if h == low}
            chains.add(min(least, key=lambda c: spark.createDataFrame([c], [f"c{k}" for k in range(len(c))]).select(F.hash("*").alias("h")).first().h) if len(least) > 1 else min(least))
        out.append(chains or ({tuple(words) or t} if t else set()))
    return out


def jaccard(a, b):
    return 1.0 if not a and not b else len(a & b) / len(a | b)


def test_spot_signatures_against_loops(spark):
    texts = some_texts(60) + [None, "", "!!!", "?", "The", "the of", "The cat sat", "the cat sat", "the the cat of mat hat"]
    rows = {r.doc_id: r for r in spotsigs.fingerprints_with_next(docs(spark, texts)).collect()}
    plain = [t or "" for t in texts]
    after = plain[1:] + plain[:1]
    edited = [t[: len(t) - len(t) // 2] + n[: len(t) // 2] for t, n in zip(plain, after, strict=True)]
    own, other, following = spot_sets(spark, plain), spot_sets(spark, edited), spot_sets(spark, after)
    for i, t in enumerate(plain):
        r = rows[i]
        assert r.n_chars == len(t) and r.edited_sha256 == hashlib.sha256(edited[i].encode()).hexdigest()
        assert len(r.fingerprint) == 8 * len(own[i])
        assert r.near_edited == pytest.approx(jaccard(own[i], other[i])) and r.near_next == pytest.approx(jaccard(own[i], following[i]))


def test_spot_signatures_repeats_nulls_and_one_row(spark):
    got = spotsigs.fingerprints_with_next(docs(spark, ["b the x y", "b the x y", "n", "c"], [5, 5, None, 7])).collect()
    assert sorted((r.doc_id or -1, r.n_chars) for r in got) == [(-1, 1), (5, 9), (5, 9), (7, 1)]
    assert len({r.fingerprint for r in got if r.doc_id == 5}) == 1
    one = spotsigs.fingerprints_with_next(docs(spark, ["abcd"])).first()
    assert one.edited_sha256 == hashlib.sha256(b"abab").hexdigest() and one.near_next == 1.0
    assert spotsigs.fingerprints_with_next(docs(spark, [])).count() == 0


def test_spot_near_duplicates_against_all_pairs(spark):
    texts = some_texts(120) + [None, "", "the same two words", "the same two words"]
    sets = spot_sets(spark, texts)
    links = [(i, j) for i, j in itertools.combinations(range(len(texts)), 2) if jaccard(sets[i], sets[j]) >= 0.8]
    want = closed(links, range(len(texts)))
    got = {r.doc_id: r.group for r in spotsigs.near_duplicates(docs(spark, texts)).collect()}
    assert got == want and len(set(want.values())) < len(texts) - 20


SPOT_LANGUAGES = {
    "ru": "Старый мост через реку был построен в прошлом веке и с тех пор не раз менялся, но жители города по нему ходят на рынок, "
          "а дети из школы бегут к воде, где у берега стоят лодки и рыбаки продают свежую рыбу до самого вечера",
    "el": "Το παλιό γεφύρι πάνω από το ποτάμι χτίστηκε τον περασμένο αιώνα και από τότε άλλαξε πολλές φορές, μα οι κάτοικοι της πόλης "
          "περνούν με τα πόδια για την αγορά και τα παιδιά τρέχουν ως το νερό όπου οι βάρκες περιμένουν",
    "zh": "老桥是在上个世纪建成的，从那以后城里的居民每天都在桥上走过，孩子们放学了就跑到河边看小船，渔夫在岸上卖新鲜的鱼，天黑了也不回家，市场和学校有很多人来往",
    "it": "Il vecchio ponte sopra il fiume è stato costruito nel secolo scorso e da allora gli abitanti della città passano di qui per "
          "andare al mercato, mentre i ragazzi che tornano dalla scuola corrono verso la riva dove sono ferme le barche dei pescatori",
    "none": " ".join(f"vok{a}{b}lim" for a in "abcdefghij" for b in "klmnopqrst"),
}


def test_spot_signatures_of_other_languages_survive_one_changed_word(spark):
    texts = [x for t in SPOT_LANGUAGES.values() for x in (t, t[:-2] + "xq")]
    got = spotsigs.with_signatures(docs(spark, texts), "text", "sigs").select("doc_id", "sigs").orderBy("doc_id").collect()
    for i, lang in enumerate(SPOT_LANGUAGES):
        a, b = set(got[2 * i].sigs), set(got[2 * i + 1].sigs)
        assert len(a) >= 5 and jaccard(a, b) >= 0.6, (lang, len(a), jaccard(a, b))


THAI = "สะพานเก่าข้ามแม่น้ำถูกสร้างขึ้นในศตวรรษที่แล้ว และตั้งแต่นั้นมา ชาวเมืองก็เดินข้ามไปตลาดทุกวัน เด็ก ๆ วิ่งจากโรงเรียนไปที่น้ำ ที่เรือจอดอยู่ และชาวประมงขายปลาสด จนถึงเย็น แล้วกลับบ้าน"


def test_spot_signatures_have_no_border_where_their_kind_changes(spark):
    """One word less or more, at any length, with and without anchors: most signatures stay (a few words have few)."""
    plain = [f"vok{a}{b}lim" for a in "abcdefghijklm" for b in "nopqrstuvwxyz"]
    cases = [" ".join(plain[:n]) for n in range(3, 140)]
    cases += [" ".join(["the", *plain[:n]]) for n in range(3, 140)]
    cases.append(THAI)
    texts = [t for c in cases for t in (c, c + " zusatz", c.split(" ", 1)[1])]
    got = spotsigs.with_signatures(docs(spark, texts), "text", "sigs").select("doc_id", "sigs").orderBy("doc_id").collect()
    for i, c in enumerate(cases):
        own, longer = (set(got[3 * i + k].sigs) for k in (0, 1))
        assert own <= longer | {min(own)} or jaccard(own, longer) > 0, c
        assert jaccard(own, longer) >= (0.6 if len(c.split()) >= 40 else 0.0), (i, len(own), len(longer))
    kept = [jaccard(set(got[3 * i].sigs), set(got[3 * i + 1].sigs)) for i in range(2 * 137)]
    assert np.mean([k > 0 for k in kept]) > 0.97 and np.mean(kept) > 0.85


# --- op4 ------------------------------------------------------------------------------------

@pytest.mark.parametrize("seed", range(6))
def test_packing_boundaries_are_optimal(seed):
    rng = random.Random(seed)
    histogram = {x: rng.randint(1, 9) for x in rng.sample(range(60), rng.randint(1, 11))}
    lengths = sorted(histogram)
    for k in range(1, 6):
        def padding(ends):
            return sum(c * (min(e for e in ends if e >= x) - x) for x, c in histogram.items())
        best = min(padding((*c, lengths[-1])) for m in range(k) for c in itertools.combinations(lengths[:-1], m))
        got = packing.boundaries(histogram, k)
        assert padding(got) == best and len(got) <= k and got == sorted(set(got)) and got[-1] == lengths[-1]


def test_packing_whole(spark):
    texts = some_texts(200) + [None, "", "", "z" * 1000]
    rows = packing.pack(docs(spark, texts), F.octet_length(F.coalesce("text", F.lit(""))), window=128, buckets=4, budget=500, segment=16).collect()
    total = Counter()
    for r in rows:
        total[r.doc_id] += r.n_tokens
        assert r.n_tokens <= r.bucket_len <= 128 and r.padding == r.bucket_len - r.n_tokens
    assert dict(total) == {i: len((t or "").encode()) for i, t in enumerate(texts)}
    batches = Counter((r.bucket, r.batch) for r in rows)
    room = {r.bucket: max(1, 500 // max(1, r.bucket_len)) for r in rows}
    assert len({(r.bucket, r.batch, r.slot) for r in rows}) == len(rows)
    for b in room:
        own = sorted((k[1], n) for k, n in batches.items() if k[0] == b)
        assert [k for k, _ in own] == list(range(len(own))) and all(n == room[b] for _, n in own[:-1]) and own[-1][1] <= room[b]
    histogram = Counter(r.n_tokens for r in rows)
    assert sorted({r.bucket_len for r in rows}) == packing.boundaries(histogram, 4)
    assert packing.pack(docs(spark, []), F.length("text")).count() == 0


# --- op5 ------------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def tiktoken_encoding():
    import tiktoken
    with open(public_tokenizers.path(RANKS), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_equals_the_library(spark, tiktoken_encoding):
    rng = random.Random(1)
    texts = ODD + ["".join(chr(rng.choice([rng.randrange(32, 127), rng.randrange(160, 0x2000), rng.randrange(0x4E00, 0x9000)])) for _ in range(rng.randint(1, 80))) for _ in range(300)]
    texts += ["a" * n for n in range(1, 70)] + ["ab" * 400, " " * 300, "\n" * 77, "=" * 1000]
    rows = {r.doc_id: r for r in bpe.round_trip(docs(spark, texts), public_tokenizers.path(RANKS), public_tokenizers.PATTERN).collect()}
    for i, t in enumerate(texts):
        ids = tiktoken_encoding.encode_ordinary(t or "")
        assert rows[i].n_tokens == len(ids), t
        assert rows[i].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert rows[i].decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest()


def test_bpe_columns_round_trip(spark):
    path, pattern = public_tokenizers.path(RANKS), public_tokenizers.PATTERN
    back = bpe.decode_column(bpe.encode_column(docs(spark, ODD), path, pattern), path, pattern)
    assert {r.doc_id: bytes(r.data).decode() for r in back.collect()} == {i: t or "" for i, t in enumerate(ODD)}
    assert bpe.encode_column(docs(spark, []), path, pattern).count() == 0


# --- op6 ------------------------------------------------------------------------------------

def test_warc_parse_by_declared_length():
    body = b"GET\n\nhttp://x 1.1.1.1 20200101000000 text/html 5\nWARC/1.0\r\n"
    v1 = b"filedesc://a.arc 0.0.0.0 20240101000000 text/plain 75\n1 0 x\nURL IP-address Archive-date Content-type Archive-length\n" + b" " * (75 - 66 - 1) + b"\n"
    about = b"2 0 x\n" + " ".join(warc.ARC_FIELDS[2]).encode() + b"\n\n"
    for head, line in ((b"filedesc://a.arc 0.0.0.0 20240101000000 text/plain %d\n" % 66 + b"1 0 x\nURL IP-address Archive-date Content-type Archive-length\n\n",
                        b"http://u 9.9.9.9 20200102030405 text/html; charset=x %d\n"),
                       (b"filedesc://a.arc 0.0.0.0 20240101000000 text/plain 200 - - 0 a.arc %d\n" % len(about) + about,
                        b"http://u 9.9.9.9 20200102030405 text/html; charset=x 200 - - 0 a.arc %d\n")):
        if head.startswith(b"filedesc") and b"1 0 x" in head:
            inner = head.split(b"\n", 1)[1]
            head = head.replace(b" 66\n", b" %d\n" % len(inner))
        got = list(warc.parse_arc(io.BytesIO(head + (b"\n" + line % len(body) + body) * 2)))
        assert [r["block"] for r in got] == [body, body] and got[0]["mime"] == "text/html; charset=x" and got[0]["url"] == "http://u"
    assert v1
    with pytest.raises(ValueError):
        list(warc.parse_arc(io.BytesIO(b"http://u 1 2 3 1\nx")))


def test_warc_conversion(spark, tmp_path):
    big = "<p>" + "WARC/1.0\r\nhttp://x 1.1.1.1 20200101000000 text/html 5\n" * 40
    pages = [(1, "http://a b", big), (7, None, big), (3, "http://c", big), (4, "u", None), (5, "u", ""), (6, "u", "s" * 999), (8, "u", "s" * 999),
             (9, "u", "é" * 500), (10, "u", "é" * 500), (10, "u", "é" * 500), (None, "u", "lonely")]
    spark.createDataFrame(pages, "page_id long, url string, html string").repartition(3).write.parquet(str(tmp_path / "pages.parquet"))
    got = sorted(queries.op6_arc_to_warc(spark, str(tmp_path)).collect(), key=str)
    assert len(got) == len(pages)
    by = {r.page_id: r for r in got if r.page_id != 10}
    assert (by[7].record_type, by[7].refers_to) == ("response", None)
    assert (by[1].record_type, by[1].refers_to, by[3].record_type, by[3].refers_to) == ("revisit", 7, "revisit", 7)
    assert all(by[k].record_type == "response" for k in (4, 5, 6, 8, None))
    assert (by[9].record_type, by[9].refers_to) == ("revisit", 10)
    assert sorted((r.record_type, r.refers_to or 0) for r in got if r.page_id == 10) == [("response", 0), ("revisit", 10)]
    for page, _, html in pages:
        r = next(x for x in got if x.page_id == page)
        assert (r.payload_bytes, r.payload_digest) == (len((html or "").encode()), hashlib.sha1((html or "").encode()).hexdigest())


def test_warc_archives_of_one_name_in_two_folders_are_two(spark, tmp_path):
    import glob
    import os
    big = "<p>" + "same text in both archives " * 60
    for folder, page in (("a", 1), ("b", 2)):
        block = warc.http_block(F.lit(big).cast("binary"), "text/html", X_Page_Id=F.lit(page))
        warc.write_arc(spark.range(1).coalesce(1).select(F.lit("http://x/").alias("url"), F.lit("20240101000000").alias("date"), block.alias("block")), f"{tmp_path}/arc/{folder}")
        (part,) = [f for f in glob.glob(f"{tmp_path}/arc/{folder}/*") if "part-" in f]
        os.rename(part, f"{tmp_path}/arc/{folder}/one.arc" + (".gz" if part.endswith(".gz") else ""))
    warc.convert(spark, f"{tmp_path}/arc", f"{tmp_path}/warc", "X-Page-Id")
    got = warc.read_warc(spark, f"{tmp_path}/warc", "X-Page-Id").collect()
    assert len({r.record_id for r in got}) == 2 and sorted((r.key, r.record_type) for r in got) == [(1, "revisit"), (2, "response")]


# --- op7 ------------------------------------------------------------------------------------

def test_language_held_out(spark):
    rows = queries.op7_language_id(spark, "/root/testdata/sf0.01").join(
        spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert all(zlib.crc32(str(r.doc_id).encode()) % 4 == 2 and 0 <= r.score <= 1 for r in rows)
    assert np.mean([r.lang_pred == r.lang for r in rows]) > 0.98


def test_language_edges(spark):
    train = spark.createDataFrame([(1, "the cat and the dog", "en"), (2, "der hund und die katze", "de"), (3, None, "en"), (4, "x", None), (5, "7", "fr")],
                                  "doc_id long, text string, lang string")
    model = langid.train(train)
    df = spark.createDataFrame([("the dog", "a"), ("die hunde", "b"), (None, "c"), ("", "d"), ("12 !!", "e")], "text string, lang_pred string")
    got = langid.identify(df, model, columns=("p", "s")).collect()
    assert [r.p for r in got] == ["en", "de", "und", "und", "und"] and [r.lang_pred for r in got] == list("abcde")
    none = langid.train(train.filter("false"))
    assert {r.p for r in langid.identify(df, none, columns=("p", "s")).collect()} == {"und"}


def test_language_learns_every_language(spark):
    rng = random.Random(8)
    own = {f"l{k:02d}": ["".join(rng.choice("abcdefghijklmnop") for _ in range(6)) for _ in range(20)] for k in range(70)}
    rows = [(i * 100 + k, " ".join(rng.choices(own[x], k=60)), x) for k, x in enumerate(own) for i in range(8 if k < 64 else 7)]
    model = langid.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert model.langs == tuple(sorted(own))
    new = [(" ".join(rng.choices(own[x], k=60)), x) for x in own]
    got = langid.identify(spark.createDataFrame(new, "text string, lang string"), model).collect()
    assert [r.lang_pred for r in got] == [r.lang for r in got] and min(r.score for r in got) > 0.5


def plain_language(model, text):
    """(language, score) by the stated rule, one word at a time."""
    import math

    import regex
    words = regex.findall(r"\p{L}+", (text or "").lower())
    if not words or not model.langs:
        return "und", 0.0
    table = {}
    for row in range(len(model.begin) - 1):
        table[row] = {int(model.langs_of[c]): float(model.above[c]) for c in range(model.begin[row], model.begin[row + 1])}
    total = [0.0] * len(model.langs)
    for w in words:
        if w in model.words:
            size, rows = 0, [model.words[w]]
        else:
            marked = f"<{w}>"
            size, rows = 0, []
            for n in range(langid.LONGEST, 0, -1):
                rows = [model.grams[n - 1][g] for i in range(len(marked) - n + 1) if (g := marked[i:i + n]) in model.grams[n - 1]]
                if rows:
                    size = n
                    break
            if not rows:
                continue
        for k in range(len(total)):
            total[k] += sum(float(model.unseen[size][k]) + table[r].get(k, 0.0) for r in rows) / len(rows)
    total = [float(p) + t / math.sqrt(len(words)) for p, t in zip(model.prior, total, strict=True)]
    best = max(range(len(total)), key=lambda k: (total[k], -k))
    return model.langs[best], 1 / sum(math.exp(t - total[best]) for t in total)


def test_language_against_a_plain_scorer_on_all_rows(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langid.train(table, where=queries.fold("doc_id", 4) != 2)
    extra = docs(spark, [*ODD, "zzzz qqqq", "é", "ǆ ß ﬁ", "x" * 100_000, "the " * 50_000], range(10**6, 10**6 + len(ODD) + 5))
    rows = langid.identify(table.unionByName(extra), model).collect()
    for r in rows:
        lang, score = plain_language(model, r.text)
        assert r.lang_pred == lang and r.score == pytest.approx(score, abs=1e-9), r.doc_id


def test_language_keeps_every_word_of_the_sample_and_ties_go_to_the_first(spark):
    rng = random.Random(4)
    words = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(9)) for _ in range(40_000)]
    rows = [(k, " ".join(words[k * 100:(k + 1) * 100]), "xx") for k in range(400)] + [(1000 + k, "same word here", lang) for k, lang in enumerate(["bb", "aa"])]
    model = langid.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert len([w for w in words if w in model.words]) == len(words)
    tie = langid.train(spark.createDataFrame(rows[400:], "doc_id long, text string, lang string"))
    got = langid.identify(spark.createDataFrame([("same word", 1), ("other", 2)], "text string, n int"), tie).collect()
    assert [r.lang_pred for r in got] == ["aa", "aa"] and got[0].score == pytest.approx(0.5)
    assert langid.identify(spark.createDataFrame([], "text string"), tie).count() == 0
    small = langid.train(spark.createDataFrame(rows[:400], "doc_id long, text string, lang string"), size=20_000)
    assert 500 < len(small.words) < 4000                  # the sample is bounded in bytes, in passages of all its texts


# --- op8 ------------------------------------------------------------------------------------

def test_chat_one_very_long_turn_takes_a_few_times_its_bytes():
    import os
    import subprocess
    import sys
    code = ("import resource, numpy as np, pyarrow as pa\n"
            "from reelhouse.llm import chat\n"
            "text = 'word & <b> ' * 100 + 'plain text ' * 4_500_000\n"
            "texts = pa.array([text, 'short'])\n"
            "before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss\n"
            "parts, first, spans = chat.assemble(np.array([0, 0]), pa.array(['user', 'assistant']), texts)\n"
            "print((resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) // 1024)\n"
            "assert list(chat.parse(parts[0].as_py())) == [('user', text), ('assistant', 'short')]\n")
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    done = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, check=True)
    assert int(done.stdout.split()[-1]) < 300


def test_chat_round_trip(spark):
    rng = random.Random(2)
    nasty = [None, "", "</turn>\n", "<turn>user\nhi</turn>\n", "&lt;&amp;&#10;", "\\### Assistant: </turn> ok", "é\U0001f600<", "\n", "x" * 3000]
    rows = [(c, t, rng.choice(["user", "assistant", "system", None, "odd\nrole<&"]), rng.choice(nasty)) for c in range(30) for t in range(rng.randint(1, 9))]
    rows += [(99, t, "assistant" if t % 2 else "user", f"turn {t} " + "y" * 400) for t in range(6000)]        # one long conversation
    rows += [(None, None, "assistant", "n"), (5, None, "user", "first"), (6, 0, "user", "twice"), (6, 0, "user", "twice")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    parts = stage(chat.format_conversations(df), "chat-test")
    got = {r.conv_id: r for r in chat.read_back(parts).collect()}
    groups = {}
    for c, t, r, x in rows:
        groups.setdefault(c, []).append((t is not None, t or 0, r or "", x or ""))
    whole = {}
    for p in sorted(parts.collect(), key=lambda p: (p.shard, p.part)):
        whole[p.conv_id] = whole.get(p.conv_id, "") + p.formatted
    assert set(got) == set(groups)
    for c, turns in groups.items():
        turns.sort()
        loss = "".join(x for *_, r, x in turns if r == "assistant")
        assert got[c].n_turns == len(turns)
        assert got[c].turns_sha256 == hashlib.sha256("".join(f"{r}\n{x}\n" for *_, r, x in turns).encode()).hexdigest()
        assert (got[c].loss_chars, got[c].loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
        assert list(chat.parse(whole[c])) == [(r, x) for *_, r, x in turns] and got[c].formatted_chars == len(whole[c])
    assert parts.filter("conv_id = 99").count() > 1
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.read_back(chat.format_conversations(empty)).count() == 0


@pytest.mark.parametrize("turn", [None, 3])
def test_chat_order_of_rows_of_one_turn_over_several_partitions(spark, turn):
    rng = random.Random(5)
    rows = [(1, turn, rng.choice(["user", "assistant"]), f"{rng.choice(['', 'x' * 1500])}{rng.random()} " + "y" * 100) for _ in range(4000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        parts = stage(chat.format_conversations(df), "chat-order")
        assert parts.select("shard").distinct().count() > 2
        got = chat.read_back(parts).first()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    turns = sorted((r, x) for *_, r, x in rows)
    assert got.n_turns == 4000 and got.turns_sha256 == hashlib.sha256("".join(f"{r}\n{x}\n" for r, x in turns).encode()).hexdigest()
    assert got.loss_sha256 == hashlib.sha256("".join(x for r, x in turns if r == "assistant").encode()).hexdigest()


# --- op9 ------------------------------------------------------------------------------------

def plain_fingerprint(text):
    import xxhash
    words = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i:i + 4]), seed=42) for i in range(max(1, len(words) - 3))] if words else []
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def test_simhash_against_all_pairs(spark):
    texts = some_texts(150) + ODD + ["same"] * 40
    fp = [plain_fingerprint(t) for t in texts]
    links = [(i, j) for i, j in itertools.combinations(range(len(texts)), 2) if (fp[i] ^ fp[j]).bit_count() <= 4]
    want = closed(links, range(len(texts)))
    got = {r.id: (r.fp % (1 << 64), r.least) for r in simhash.near_duplicates(docs(spark, texts), 4, 4).collect()}
    assert got == {i: (fp[i], want[i]) for i in range(len(texts))}


def clustered_bits(rng, n=300, bits=64):
    base = [rng.getrandbits(bits) for _ in range(n // 5)]
    out = set(base)
    while len(out) < n:
        x = rng.choice(base)
        for _ in range(rng.randint(0, 6)):
            x ^= 1 << rng.randrange(bits)
        out.add(x)
    centre = rng.getrandbits(bits)
    out |= {centre ^ (1 << a) ^ (1 << b) for a in range(12) for b in range(12, 40)}       # a large group of near copies
    return sorted(out)


@pytest.mark.parametrize("tau,parts", [(4, None), (4, [1, 1, 0]), (4, [2, 1]), (4, [1, 0, 0, 0]), (2, None), (0, None)])
def test_simhash_links_for_any_thresholds(spark, monkeypatch, tau, parts):
    fp = clustered_bits(random.Random(5))
    if parts:
        step = 64 // len(parts)
        fixed = [(list(range(i * step, 64 if i == len(parts) - 1 else (i + 1) * step)), t) for i, t in enumerate(parts)]
        monkeypatch.setattr(simhash, "plan", lambda *a: fixed)
    df = spark.createDataFrame([(i, f - (1 << 64) if f >> 63 else f) for i, f in enumerate(fp)], "id long, fp long")
    want = closed([(i, j) for i, j in itertools.combinations(range(len(fp)), 2) if (fp[i] ^ fp[j]).bit_count() <= tau], range(len(fp)))
    assert {r.fp % (1 << 64): r.least for r in simhash.linked_components(df, tau).collect()} == {f: want[i] for i, f in enumerate(fp)}


def test_simhash_thresholds_cover_every_pair():
    cost, chosen = simhash.allocate([[5, 9, 20, 40, 90]] * 3, [[1, 22, 232, 1562, 7547]] * 3, 4)
    assert sum(chosen) == 4 - 3 + 1 and cost > 0
    every = min(sum(5 if t == 0 else [5, 9, 20, 40, 90][t] for t in c if t >= 0) + simhash.PROBE_COST * sum([1, 22, 232, 1562, 7547][t] for t in c if t >= 0)
                for c in itertools.product(range(-1, 5), repeat=3) if sum(c) == 2)
    assert cost == every
    rng = np.random.default_rng(0)
    together = rng.random((64, 64))
    groups = simhash.grouped_bits(together + together.T + 64 * np.eye(64), 200, 5)
    assert sorted(itertools.chain(*groups)) == list(range(64))


def test_simhash_keep_one(spark):
    long = " ".join(f"w{i}" for i in range(400))
    df = spark.createDataFrame([(3, long, "a", "b"), (2, long + " end", "c", "d"), (2, long + " end", "c", "d"), (None, long, "e", "f"),
                                (9, None, "g", "h"), (8, "", "i", "j"), (None, "alone here", "k", "l")], "doc_id long, text string, row string, doc string")
    got = simhash.keep_one(df, 4, 4)
    assert got.columns == df.columns and sorted(map(str, (r.doc_id for r in got.collect()))) == ["2", "8", "None"]
    assert simhash.keep_one(df.filter("false"), 4, 4).count() == 0
    assert simhash.near_duplicates(docs(spark, []), 4, 4).count() == 0


def test_digest_index_grows_by_buckets():
    """A bucket is one task's share, so their number follows the rows, between the two bounds."""
    assert exact_dedup.buckets_for(0) == exact_dedup.buckets_for(1_000_000) == exact_dedup.LEAST_BUCKETS
    assert exact_dedup.buckets_for(50_000_000_000) == 12_500
    assert exact_dedup.buckets_for(10 ** 15) == exact_dedup.MOST_BUCKETS


def test_components_of_stars_chains_and_grids(spark):
    """Links that are stars already end without a round; long chains, cycles and crossing stars give one label each."""
    schema = "a long, b long"
    stars = [(i, i % 7) for i in range(7, 300)]
    chain = [(1000 + i, 1001 + i) for i in range(130)]
    cycle = [(2000 + i, 2000 + (i + 1) % 9) for i in range(9)]
    grid = [(3000 + 10 * x + y, 3000 + 10 * u + v) for x in range(6) for y in range(6) for u, v in ((x + 1, y), (x, y + 1)) if u < 6 and v < 6]
    for links in (stars, chain, cycle, grid, [*stars, *chain, *cycle, *grid, *stars]):
        want = closed(links, {n for link in links for n in link})
        got = components.components(spark.createDataFrame(links, schema)).collect()
        assert len(got) == len(want) and {r.node: r.component for r in got} == want


def test_components(spark):
    rng = random.Random(4)
    links = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)] + [(i, i + 1) for i in range(500, 560)] + [(700, i) for i in range(701, 900)]
    want = closed([x for x in links if x[0] != x[1]], {n for x in links if x[0] != x[1] for n in x})
    assert {r.node: r.component for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()} == want
    assert components.components(spark.createDataFrame([(1, 1), (None, 2)], "a long, b long")).count() == 0


# --- op10 -----------------------------------------------------------------------------------

def test_token_counts_equal_the_library(spark, monkeypatch):
    import sentencepiece as sp
    path = public_tokenizers.path("piece_bpe_32k.model")
    rng = random.Random(6)
    long = [" " * k + "".join(rng.choice(["word ", "été", " ", "  ", "\n", "▁", "x" * 30, "日本 ", "▁ a"]) for _ in range(40_000)) for k in range(3)]
    texts = ODD + long + ["y" * 100_000, " " * 70_000]
    model = sp.SentencePieceProcessor(model_file=path)
    got = {r.doc_id: r for r in tokencount.token_counts(docs(spark, texts), path).collect()}
    for i, t in enumerate(texts):
        assert (got[i].n_bytes, got[i].n_tokens) == (len((t or "").encode()), len(model.encode(t or "")))
    assert len(tokencount.cut(long[0])) > 3
    assert tokencount.token_counts(docs(spark, []), path).count() == 0


def test_token_counts_json(spark):
    from tokenizers import Tokenizer
    path = public_tokenizers.path("byte_bpe_50k.json")
    model = Tokenizer.from_file(path)
    got = {r.doc_id: r.n_tokens for r in tokencount.token_counts(docs(spark, ODD), path).collect()}
    assert got == {i: len(model.encode(t or "", add_special_tokens=False).ids) for i, t in enumerate(ODD)}


# --- queries and pipeline -------------------------------------------------------------------

@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_matches_sql(spark, name):
    import duckdb
    from tools.check_oracle import rows_of
    con = duckdb.connect()
    for t in ("documents", "pages", "conversations", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = queries.QUERIES[name](spark, SF)
    res = con.execute(queries.ORACLE[name])
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of([c[0] for c in res.description], res.fetchall())


def test_pipeline_stages(spark):
    before = spark.read.parquet(f"{SF}/documents.parquet")
    columns = before.columns
    assert [k for k, _ in corpus_pipeline.STAGES] == ["language_id", "quality", "exact_dedup", "simhash_near_dedup", "packing"]
    got = before
    extra = before.withColumn("score", F.lit("x")).withColumn("row", F.lit(1)).withColumn("quality_score", F.lit(2))
    for name, step in corpus_pipeline.STAGES[:-1]:
        kept = stage(step(spark, got, SF), f"test-{name}")
        assert kept.columns == columns and kept.exceptAll(got).count() == 0
        assert step(spark, extra, SF).columns == extra.columns
        got = kept
    texts = [r.text for r in got.collect()]
    assert len({re.sub(r"[\x20\x09-\x0D]+", " ", t) for t in texts}) == len(texts)
    fps = [plain_fingerprint(t) for t in texts]
    assert all((a ^ b).bit_count() > 4 for a, b in itertools.combinations(fps, 2))
    packed = corpus_pipeline.pack(spark, got, SF).groupBy("doc_id").agg(F.sum("n_tokens").alias("n")).collect()
    assert {r.doc_id: r.n for r in packed} == {r.doc_id: len(r.text.encode()) + 1 for r in got.collect()}
    assert 0.7 * before.count() < len(texts) < before.count()


def test_pipeline_on_odd_and_empty_rows(spark):
    odd = docs(spark, ODD + ODD, [*range(len(ODD)), *([None] * len(ODD))])
    for frame in (odd, odd.filter("false")):
        got = frame
        for _, step in corpus_pipeline.STAGES:
            got = stage(step(spark, got, SF), "test-odd")
        assert got.count() <= 2 * len(ODD)
