"""Document fingerprints by spot signatures, in DataFrame functions only.

A text is lower-cased and cut into words (runs of letters and digits; Chinese and Japanese runs are
cut at their function characters too). Very common words are anchors: a fixed list for languages in
Latin script, the function characters, and in other scripts every word of at most three letters, as
function words are short. All others are content words. After each run of anchors, its last
word and the next `CHAIN` content words, anchors between them skipped, form one signature: a
32-bit hash. Boilerplate without running speech has few anchors and so
few such signatures, and so has a language that no rule above meets. Therefore every text also gets a chain at
each content word whose hash is a multiple of `PICK`, and at the one with the least hash: that word and the next `CHAIN`. These depend on
the words alone, never on how many a text has, so a changed word changes the chains that hold it and no others (or, with chance one in the text's words, the
least one). The fingerprint is the set of signatures. A text with no chain at all (fewer than `CHAIN` + 1 content words) has one
signature, of all its words, or of the raw text if it has no word; only the empty text has none. Very long texts are read whole.

Two fingerprints are compared by Jaccard similarity, pruned by set length: the similarity is at
most the shorter length over the longer. Lengths fall into classes whose borders grow by
1 / threshold, so sets that are similar enough lie in the same or in neighbouring classes.
`near_duplicates` joins within those on each set's rarest signatures (as two sets of similarity t
share one of the (1 - t) * length + 1 rarest), verifies candidates on the whole sets and
returns links between different sets; equal sets are one member of the join.

Null texts count as empty. Two empty fingerprints have similarity 1, an empty and another one 0.
Rows with equal id and text are one document for the order of documents, and each
of them gets a row. A null id comes first. Rows with equal ids and different texts are
ordered by a hash. An empty table gives an empty result. Only the id and the text are read, so
extra columns cannot clash.
"""

from __future__ import annotations

from math import log

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from reelhouse.llm.common import stage, utf8
from reelhouse.llm.components import components

# Common words that serve as anchors, by language.
ANCHORS = """
a an and are as at be but by for from had has have he her his i in is it its not of on or she so that the their they this to was we were what which will with you
au aux avec ce ces dans de des du elle en est et il ils je la le les leur lui mais ne nous on ou par pas plus pour que qui sa se ses son sont sur un une vous
aber als am auch auf aus bei das dem den der des die ein eine einen einer er es für hat ich ihr im ist mit nach nicht noch sein sich sie sind über um und vom von war wie wir zu zum zur
al como con del el ella ellos entre era esta este fue ha las lo los más me mi muy no nos para pero por sin su sus también te tiene todo una uno y ya
che di della dei è gli il nel più sono
ao às da do dos em foi mas não os pelo são uma
aan bij dat een het maar niet ook te van voor werd wordt zijn
att av det ett från för han inte jag och på som till var
af at blev der eller fra har ikke med og på til
ale do jak jest na nie od przez się to w z że
ako ale byl jako je jsou která který na pro před se v ve že
care cu din este la mai nu pe pentru prin și sunt
bir bu çok da daha de gibi için ile olan olarak ve
ei että hän ja joka kun mutta myös ne oli on ovat se
az egy és hogy is meg nem volt
ada dalam dan dari dengan di ini itu ke oleh pada untuk yang
các cho có của đã được là một những này không trong và với
katika kwa na ni wa ya za
""".split()
#: Chinese and Japanese function characters; each is a word of its own, and an anchor.
CHARACTERS = "的了是在不和有这這也就のはをにがとでも"
#: Words of other scripts that are anchors by their length.
SHORT = r"[\p{L}&&[^\p{IsLatin}\p{IsHan}\p{IsHiragana}\p{IsKatakana}]]{1,3}"
#: One content word in so many starts a chain by its hash.
PICK = 8
CHAIN = 2
MARK = "\x01"
THRESHOLD = 0.8


def _anchor_pattern() -> str:
    """A regular expression for one anchor, branching on its first letter."""
    by_first: dict[str, set[str]] = {}
    for w in ANCHORS:
        by_first.setdefault(w[0], set()).add(w[1:])
    branches = (f"{a}(?:{'|'.join(sorted(rest, key=lambda x: (-len(x), x)))})" for a, rest in sorted(by_first.items()))
    return f" (?=(?:{'|'.join(branches)}|[{CHARACTERS}]|{SHORT}) )"


def with_signatures(df: DataFrame, text: str, out: str) -> DataFrame:
    """``df`` with a column ``out``: the sorted distinct signatures (array<int>) of ``text``.

    Every anchor is first glued to the word before it, with a mark instead of the space, so that
    splitting at spaces gives the content words, each with the run of anchors that follows.
    """
    s, e, c, z, p, k = (f"_{out}_{x}" for x in ("spaced", "words", "content", "chains", "picks", "hashes"))
    spaced = F.concat(F.lit(" "), F.regexp_replace(F.lower(utf8(text)), r"[^\p{L}\p{N}]+", " "), F.lit(" "))
    df = df.withColumn(s, spaced)
    df = df.withColumn(s, F.when(F.col(s).rlike(f"[{CHARACTERS}]"), F.regexp_replace(F.regexp_replace(s, f"([{CHARACTERS}])", " $1 "), " +", " ")).otherwise(F.col(s)))
    df = df.withColumn(e, F.split(F.rtrim(F.regexp_replace(F.col(s), _anchor_pattern(), MARK)), " "))
    df = df.withColumn(c, F.transform(F.col(e), lambda x: F.substring_index(x, MARK, 1)))
    size = F.greatest(F.size(e) - CHAIN, F.lit(0))
    fields = [F.slice(e, F.lit(1), size).alias("e"), *(F.slice(c, F.lit(i + 2), size).alias(f"c{i}") for i in range(CHAIN))]
    df = df.withColumn(z, F.filter(F.arrays_zip(*fields), lambda x: F.contains(x["e"], F.lit(MARK))))
    chains = F.transform(F.col(z), lambda x: F.hash(F.substring_index(x["e"], MARK, -1), *(x[f"c{i}"] for i in range(CHAIN))))
    following = F.arrays_zip(F.slice(c, F.lit(1), size).alias("w"), *(F.slice(c, F.lit(i + 2), size).alias(f"c{i}") for i in range(CHAIN)))
    spoken = F.filter(following, lambda x: x["w"] != "")
    df = df.withColumn(p, F.transform(spoken, lambda x: F.struct(F.hash(x["w"]).alias("h"), F.hash(x["w"], *(x[f"c{i}"] for i in range(CHAIN))).alias("sig"))))
    picked = F.filter(F.col(p), lambda x: F.pmod(x["h"], F.lit(PICK)) == 0)
    least = F.when(F.size(p) > 0, F.array(F.array_min(p)["sig"])).otherwise(F.array().cast("array<int>"))
    chains = F.concat(chains, F.transform(picked, lambda x: x["sig"]), least)
    df, chains = df.withColumn(k, chains), F.col(k)
    whole = F.when(F.trim(s) != "", F.hash(s)).otherwise(F.hash(utf8(text)))
    found = F.when(F.size(k) > 0, F.array_sort(F.array_distinct(chains))).when(utf8(text) == "", F.array().cast("array<int>")).otherwise(F.array(whole))
    return df.withColumn(out, found).drop(s, e, c, z, p, k)


def fingerprint(signatures: Column | str) -> Column:
    """The signature set as text: 8 hex digits for each, in order."""
    col = F.col(signatures) if isinstance(signatures, str) else signatures
    return F.array_join(F.transform(col, lambda x: F.lower(F.lpad(F.hex(x.cast("long").bitwiseAND(0xFFFFFFFF)), 8, "0"))), "")


def length_class(signatures: str, threshold: float = THRESHOLD) -> Column:
    """The class of the set's length; sets of similarity ``threshold`` differ by one class at most."""
    return F.floor(F.log(F.greatest(F.size(signatures), F.lit(1)).cast("double")) / F.lit(-log(threshold)) + F.lit(1e-9)).cast("int")


def pruned_jaccard(a: str, b: str, least: float = 0.0) -> Column:
    """Jaccard similarity of two signature sets; 0 where the lengths alone rule out ``least``."""
    na, nb = F.size(a), F.size(b)
    shared = F.size(F.array_intersect(a, b))
    bound = F.least(na, nb) / F.greatest(na, nb, F.lit(1))
    return (F.when((na == 0) & (nb == 0), F.lit(1.0)).when((bound == 0) | (bound < least), F.lit(0.0))
            .otherwise(shared / (na + nb - shared)).cast("double"))


# --- documents and the next one ---------------------------------------------------------------

def _ordered_keys(docs: DataFrame) -> DataFrame:
    """(k0, k1, h, copies, p0, p1, ph, before): each distinct (id, text) with its predecessor's key and length.

    The order is made by range partitions: predecessors within a partition by a window over it,
    those across by a table of one row for each partition.
    """
    keys = docs.groupBy("k0", "k1", "h").agg(F.count("*").alias("copies"), F.min("n").alias("n"))
    order = [F.desc("k0"), F.asc("k1"), F.asc("h")]
    ranged = stage(keys.repartitionByRange(*order).withColumn("shard", F.spark_partition_id()), "spotsigs-keys")
    # In a shard, keys are ordered as structs; k0 is inverted so that null ids come first.
    key = F.struct((~F.col("k0")).alias("r0"), "k1", "h", "n")
    ends = ranged.groupBy("shard").agg(F.min(key).alias("first"), F.max(key).alias("last"))
    every = W.partitionBy(F.lit(0)).orderBy("shard")
    whole = every.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    ends = ends.select("shard", F.coalesce(F.lag("last").over(every), F.last("last").over(whole)).alias("prior"))   # one row for each shard
    within = W.partitionBy("shard").orderBy(*order)
    linked = ranged.withColumn("own", F.lag(key).over(within)).join(F.broadcast(ends), "shard")
    prev = F.coalesce("own", "prior")
    return linked.select("k0", "k1", "h", "copies", (~prev["r0"]).alias("p0"), prev["k1"].alias("p1"), prev["h"].alias("ph"), prev["n"].alias("before"))


def with_next(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Each document with its signatures, its edited text and the next document's signatures.

    Returns (doc_id, n_chars, copies, sigs, edited, next_sigs); the edited text has its last floor(n / 2)
    code points replaced by the first as many of the next document.
    """
    kind = docs.schema[id_col].dataType
    base = docs.select(F.col(id_col).isNull().alias("k0"), F.coalesce(id_col, F.lit(0)).alias("k1"), F.xxhash64(utf8(text)).alias("h"), utf8(text).alias("text"))
    keys = stage(_ordered_keys(base.select("k0", "k1", "h", F.char_length("text").cast("long").alias("n"))), "spotsigs-order")
    once = W.partitionBy("k0", "k1", "h").orderBy("k0", "k1", "h")
    # Signatures are taken before the texts are shuffled. Both sides below read the same columns, so Spark does both once and reuses that.
    joined = with_signatures(base, "text", "sigs").join(keys, ["k0", "k1", "h"])
    signed = joined.withColumn("_rn", F.row_number().over(once)).filter("_rn = 1").drop("_rn").withColumn("n", F.char_length("text"))
    head = F.substring("text", F.lit(1), F.col("n") - F.floor(F.col("n") / 2).cast("int"))
    own = signed.select("k0", "k1", "h", F.when(~F.col("k0"), F.col("k1")).cast(kind).alias("doc_id"), F.col("n").cast("long").alias("n"), "copies", "sigs", head.alias("head"))
    following = signed.select(F.col("p0").alias("k0"), F.col("p1").alias("k1"), F.col("ph").alias("h"),
                              F.substring("text", F.lit(1), F.floor(F.col("before") / 2).cast("int")).alias("start"), F.col("sigs").alias("next_sigs"))
    both = own.join(following, ["k0", "k1", "h"])
    return both.select("doc_id", F.col("n").alias("n_chars"), "copies", "sigs", F.concat("head", "start").alias("edited"), "next_sigs")


def fingerprints_with_next(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each row of ``docs``: fingerprints of the text and its edited text, and their likeness."""
    rows = with_signatures(with_next(docs, id_col, text), "edited", "edited_sigs")
    out = rows.select(
        "doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"), fingerprint("sigs").alias("fingerprint"),
        fingerprint("edited_sigs").alias("edited_fingerprint"), pruned_jaccard("sigs", "edited_sigs").alias("near_edited"),
        pruned_jaccard("sigs", "next_sigs").alias("near_next"), length_class("sigs").alias("length_class"), "copies")
    return out.withColumn("_copy", F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int")))).drop("_copy", "copies")


# --- near-duplicates --------------------------------------------------------------------------

def _verified(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b) of set keys whose sets reach the threshold."""
    left = sets.select(F.col("set").alias("a"), F.col("sigs").alias("sa"))
    right = sets.select(F.col("set").alias("b"), F.col("sigs").alias("sb"))
    return pairs.distinct().join(left, "a").join(right, "b").filter(pruned_jaccard("sa", "sb", threshold) >= threshold).select("a", "b")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, group) for each row: ``group`` is the smallest id that links of similarity ``threshold`` lead to.

    Each set meets others at its rarest signatures, in its own length class and the next one up. First every
    set is held against one centre of such a meeting place, which joins the members of a large group by few
    links; then only sets of different groups are compared. Empty texts are one group.
    """
    rows = with_signatures(docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("_text")), "_text", "sigs")
    rows = stage(rows.select("doc_id", "sigs", F.unhex(F.md5(fingerprint("sigs").cast("binary"))).alias("set")), "spotsigs-rows")
    sets = stage(rows.groupBy("set").agg(F.min("doc_id").alias("id"), F.first("sigs").alias("sigs")), "spotsigs-sets")
    each = sets.select("set", F.explode("sigs").alias("sig"))
    seen = stage(each.groupBy("sig").agg(F.count("*").alias("df")), "spotsigs-df")
    ranked = each.join(seen, "sig").groupBy("set").agg(F.array_sort(F.collect_list(F.struct("df", "sig"))).alias("sigs"))
    n = F.size("sigs")
    rarest = F.slice("sigs", F.lit(1), n - F.ceil(n * threshold - 1e-9).cast("int") + 1)
    places = stage(ranked.select("set", n.alias("n"), length_class("sigs", threshold).alias("class"), F.explode(rarest).alias("at"))
                   .select("set", "n", "class", F.col("at.sig").alias("sig")), "spotsigs-places")
    probes = places.select(F.col("set").alias("a"), F.col("n").alias("na"), "sig", F.explode(F.array("class", F.col("class") + 1)).alias("class"))
    centres = places.groupBy("sig", "class").agg(F.min("set").alias("b"))
    stars = components(_verified(probes.join(centres, ["sig", "class"]).filter("a <> b").select("a", "b"), sets, threshold))
    named = stage(sets.select("set").join(stars, F.col("set") == F.col("node"), "left").select("set", F.coalesce("component", "set").alias("comp")), "spotsigs-stars")
    left = probes.join(named.select(F.col("set").alias("a"), F.col("comp").alias("ca")), "a")
    right = places.join(named, "set").select("sig", "class", F.col("set").alias("b"), F.col("n").alias("nb"), F.col("comp").alias("cb"))
    met = left.join(right, ["sig", "class"]).filter((F.col("ca") != F.col("cb")) & (F.col("na") >= F.col("nb") * threshold - 1e-9) & (F.col("nb") >= F.col("na") * threshold - 1e-9))
    links = stage(_verified(met.select("a", "b"), sets, threshold), "spotsigs-links")
    between = links.join(named.select(F.col("set").alias("a"), F.col("comp").alias("ca")), "a").join(named.select(F.col("set").alias("b"), F.col("comp").alias("cb")), "b")
    joined = components(between.select(F.col("ca").alias("a"), F.col("cb").alias("b")))
    groups = stage(named.join(joined, F.col("comp") == F.col("node"), "left").select("set", F.coalesce("component", "comp").alias("comp")).join(sets.select("set", "id"), "set"), "spotsigs-groups")
    least = groups.groupBy("comp").agg(F.min("id").alias("group"))
    return rows.select("doc_id", "set").join(stage(groups.join(least, "comp").select("set", "group"), "spotsigs-least"), "set").select("doc_id", "group")
