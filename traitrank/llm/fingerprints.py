"""SpotSigs: document fingerprints from chains of content words behind common words.

Each occurrence of a common word is a spot. Its signature is the common word and the next
``CHAIN`` content words, hashed; boilerplate has few common words and so few spots. The
fingerprint is the set of all signatures and two documents are as alike as the Jaccard
similarity of their sets. Everything is DataFrame code.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from traitrank.llm.common import shuffle_partitions
from traitrank.sources.staging import Staging

CHAIN = 2
THRESHOLD = 0.8
WORD = r"[\p{L}\p{N}]+"

# Frequent function words of English, German, French and Spanish.
COMMON_WORDS = (
    "the of and to in is that it for was on are as with be by this at from he an not or they which you a "
    "der die das und ist nicht von zu mit den des ein eine für auf im dem es sich auch er sie "
    "le la les et est que un une pour dans qui pas sur au il elle ce avec du ne "
    "el los las y en por con para del se lo como más su no al o si me"
).split()

# Bounds of ranges that are sent to the driver, whatever the size of the table.
MAX_RANGES = 4096


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value worked out once."""
    return F.transform(F.array(value), use)[0]


def signatures(text: Column, chain: int = CHAIN, common: list[str] | tuple = COMMON_WORDS) -> Column:
    """Sorted distinct 64-bit signatures of a text; [] for null and for texts without a word.

    Case and everything but letters and digits is ignored. A text without common words has every
    word as a spot, so only texts without any word have no signature. Chains at the end of the
    text are shorter.
    """
    words = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0))

    def spots(w: Column) -> Column:
        marked = F.transform(w, lambda x, i: F.when(x.isin(*common), i))
        return F.filter(marked, lambda i: i.isNotNull())

    def chains(w: Column, at: Column, content: Column) -> Column:
        # Before spot number j at word i there are i - j content words.
        return F.transform(at, lambda i, j: F.xxhash64(F.get(w, i), *[F.get(content, i - j + k) for k in range(chain)]))

    def every_word(w: Column) -> Column:
        return F.transform(w, lambda x, i: F.xxhash64(x, *[F.get(w, i + 1 + k) for k in range(chain)]))

    def of(w: Column) -> Column:
        content = F.filter(w, lambda x: ~x.isin(*common))
        return _let(
            F.struct(spots(w).alias("at"), content.alias("content")),
            lambda s: F.when(F.size(s["at"]) > 0, chains(w, s["at"], s["content"])).otherwise(every_word(w)),
        )

    return F.array_sort(F.array_distinct(_let(words, of)))


def fingerprint(sigs: Column) -> Column:
    """The set as text: sixteen hex digits per signature. Equal texts have equal fingerprints."""
    return F.array_join(F.transform(sigs, lambda s: F.lower(F.lpad(F.hex(s), 16, "0"))), "")


def likeness(a: Column, b: Column) -> Column:
    """Jaccard similarity of two signature sets, 1 if both are empty."""
    both = F.size(F.array_intersect(a, b))
    return _let(both, lambda n: F.when(F.size(a) + F.size(b) == 0, 1.0).otherwise(n / (F.size(a) + F.size(b) - n)))


def with_following(docs: DataFrame, key: str, values: list[str], make) -> DataFrame:
    """``make(docs)`` with ``next_<v>`` of the row that follows in descending ``key``.

    After the last row comes the first. Rows are dealt into ranges of about equal counts whose
    bounds are quantiles, at most ``MAX_RANGES`` numbers; the first row of a range is also sent,
    as a guard, to the range before, so no row waits for another task. Rows without key come
    last, rows with equal keys by a hash of ``values``, then by the values.
    """
    spark = docs.sparkSession
    n = min(MAX_RANGES, 4 * shuffle_partitions(spark))
    steps = [i / n for i in range(1, n)]
    bounds = docs.agg(F.percentile_approx(key, steps, 100 * n)).first()[0] or []
    above = F.array(*[F.lit(b).cast("long") for b in sorted(set(bounds))]).cast("array<bigint>")
    place = F.when(F.col(key).isNull(), n).otherwise(F.size(F.filter(above, lambda b: b > F.col(key)))).cast("int")
    placed = docs.withColumn("__range", place)
    firsts = sorted(placed.groupBy("__range").agg(F.max(key)).collect())
    if not firsts:
        firsts = [(0, None)]
    first_key, before = [F.lit(None).cast("long")] * (n + 1), [F.lit(None).cast("int")] * (n + 1)
    for i, (r, top) in enumerate(firsts):
        first_key[r], before[r] = F.lit(top).cast("long"), F.lit(firsts[i - 1][0])
    is_first = F.get(F.array(*first_key), F.col("__range")).eqNullSafe(F.col(key))
    copies = F.array(
        F.struct(F.col("__range").alias("r"), F.lit(False).alias("guard")),
        F.when(is_first, F.struct(F.get(F.array(*before), F.col("__range")).alias("r"), F.lit(True).alias("guard"))),
    )
    dealt = (
        placed.withColumn("__to", F.explode(F.filter(copies, lambda c: c.isNotNull())))
        .withColumn("__range", F.col("__to.r")).withColumn("__guard", F.col("__to.guard")).drop("__to")
        .repartition("__range")
    )
    made = make(dealt)
    order = [F.col("__guard"), F.col(key).desc_nulls_last(), F.xxhash64(*values), *[F.col(v) for v in values]]
    following = F.lead(F.struct(*[c for c in made.columns if c not in ("__range", "__guard", key)])).over(
        Window.partitionBy("__range").orderBy(*order)
    )
    found = made.withColumn("__next", following).filter("NOT __guard")
    kept = [c for c in made.columns if c not in ("__range", "__guard")]
    return found.select(*kept, *[F.col(f"__next.{c}").alias(f"next_{c}") for c in kept if c != key])


def edited_text(text: Column, following: Column) -> Column:
    """``text`` with its last third replaced by as much of the start of the following text."""
    third = F.floor(F.length(text) / 3).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - third), F.substring(following, F.lit(1), third))


def compare_with_neighbours(docs: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likeness.

    Returns ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next``, one row per row of ``docs``. Null texts are empty. A single row follows itself.
    An empty table gives an empty result; further columns are not looked at.
    """
    plain = docs.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))

    def sign(dealt: DataFrame) -> DataFrame:
        return dealt.withColumn("sigs", signatures(F.col("text")))

    met = with_following(plain, "doc_id", ["text"], sign)
    edited = met.select(
        "doc_id", F.length("text").cast("long").alias("n_chars"), "sigs", "next_sigs",
        edited_text(F.col("text"), F.col("next_text")).alias("edited"),
    ).withColumn("edited_sigs", signatures(F.col("edited")))
    return edited.select(
        "doc_id", "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        fingerprint(F.col("sigs")).alias("fingerprint"),
        fingerprint(F.col("edited_sigs")).alias("edited_fingerprint"),
        likeness(F.col("sigs"), F.col("edited_sigs")).alias("near_edited"),
        likeness(F.col("sigs"), F.col("next_sigs")).alias("near_next"),
    )


# A set that this share of all documents has is hot; by arithmetic there are at most 1/share.
_HOT = 1 / 1024
_SALTS = 32
# Sets with a signature in common that meet in one task, on one side.
_MEETING = 1024


def _set_name(sigs: Column) -> Column:
    """128 bits of the set, as two numbers."""
    return F.struct(F.xxhash64(sigs).alias("h"), F.xxhash64(F.lit(1), sigs).alias("g"))


def signature_classes(docs: DataFrame, staging: Staging) -> DataFrame:
    """(set, sigs, class_id, n_docs) of each set of signatures that a document with an id has.

    Copies meet before the shuffle by the name of their set. Documents without any signature have
    no class.
    """
    signed = docs.filter("doc_id IS NOT NULL").select("doc_id", signatures(F.col("text")).alias("sigs"))
    grouped = signed.filter(F.size("sigs") > 0).withColumn("set", _set_name(F.col("sigs"))).groupBy("set").agg(
        F.first("sigs").alias("sigs"), F.min("doc_id").alias("class_id"), F.count(F.lit(1)).alias("n_docs")
    )
    return staging.write(grouped, "classes")


def _with_class(rows: DataFrame, known: DataFrame, classes: DataFrame) -> DataFrame:
    """``rows`` with the columns of ``known`` for their set, NULL where it is not known.

    The names of hot sets, at most ``1 / _HOT``, are broadcast; their rows are spread by id.
    """
    total = classes.agg(F.sum("n_docs")).first()[0] or 0
    hot = classes.filter(F.col("n_docs") >= max(_SALTS, total * _HOT)).select("set", F.lit(_SALTS).alias("salts"))
    rows = rows.withColumn("set", _set_name(F.col("sigs"))).join(F.broadcast(hot), "set", "left")
    salt = F.pmod(F.xxhash64("doc_id"), F.coalesce("salts", F.lit(1))).cast("int")
    spread = known.join(F.broadcast(hot), "set", "left").withColumn(
        "salt", F.explode(F.sequence(F.lit(0), F.coalesce("salts", F.lit(1)) - 1))
    )
    return rows.withColumn("salt", salt).drop("salts").join(
        spread.drop("salts").hint("merge"), ["set", "salt"], "left"
    )


def class_links(classes: DataFrame, staging: Staging, threshold: float = THRESHOLD) -> DataFrame:
    """(x, y, a, b, likeness): sets x and y alike, each pair once, with their class ids.

    Sets of lengths n <= m can only be alike if n >= threshold * m, so lengths fall into
    partitions by powers of the threshold and a set meets its own and the next partition only. In
    them, sets meet at the rarest signatures that a set must share with any set alike. Both
    lengths and the places of that signature in either set, rarest first, bound what the sets can
    have in common; pairs that cannot reach the threshold go before any set is fetched, what is
    left is compared in full. A signature that many sets have is met in blocks of sets.
    """
    spread = classes.select("set", F.size("sigs").alias("len"), F.explode("sigs").alias("sig"))
    frequency = staging.write(spread.groupBy("sig").agg(F.count(F.lit(1)).alias("df")).filter("df > 1"), "frequency")
    total = frequency.agg(F.sum("df")).first()[0] or 0
    hot = frequency.filter(F.col("df") >= max(_SALTS, total * _HOT))
    # One that no other set has comes first in its set and meets nothing; it need not be looked up.
    common = _split_join(spread, frequency, hot)
    rarest = common.groupBy("set", "len").agg(
        F.array_sort(F.collect_list(F.struct("df", "sig"))).alias("by_df"), F.count(F.lit(1)).alias("n_common")
    )
    needed = (F.col("len") - F.ceil(F.col("len") * threshold - 1e-9) + 1).cast("int")
    alone = F.col("len") - F.col("n_common")
    prefix = staging.write(
        rarest.withColumn("alone", alone.cast("int")).filter(needed > F.col("alone"))
        .select(
            "set", "len", "alone",
            F.floor(F.log(F.col("len").cast("double")) / -math.log(threshold) + 1e-9).cast("int").alias("part"),
            F.posexplode(F.slice("by_df", F.lit(1), needed - F.col("alone"))).alias("at", "s"),
        )
        .select(
            "set", "len", "part", (F.col("at") + F.col("alone")).alias("at"), F.col("s.sig").alias("sig"),
            F.ceil(F.col("s.df") / _MEETING).cast("int").alias("blocks"),
        ),
        "prefix",
    )
    shorter = prefix.select(
        F.col("set").alias("x"), F.col("len").alias("len_x"), F.col("at").alias("at_x"), "sig",
        F.explode(F.array(F.col("part"), F.col("part") + 1)).alias("part"), "blocks",
    ).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("blocks")
    longer = prefix.select(
        F.col("set").alias("y"), F.col("len").alias("len_y"), F.col("at").alias("at_y"), "sig", "part",
        F.pmod(F.xxhash64("set"), F.col("blocks")).cast("int").alias("block"),
    )
    shared = F.least("at_x", "at_y") + 1 + F.least(F.col("len_x") - F.col("at_x"), F.col("len_y") - F.col("at_y")) - 1
    enough = shared * (1 + threshold) >= threshold * (F.col("len_x") + F.col("len_y")) - 1e-6
    ordered = (F.col("len_x") < F.col("len_y")) | ((F.col("len_x") == F.col("len_y")) & (F.col("x") < F.col("y")))
    candidates = staging.write(
        shorter.join(longer.hint("merge"), ["part", "sig", "block"])
        .filter(ordered & (F.col("len_x") >= threshold * F.col("len_y") - 1e-6) & enough)
        .select("x", "y").distinct(),
        "candidates",
    )

    def sets(name: str, sigs: str, class_id: str) -> DataFrame:
        return classes.select(F.col("set").alias(name), F.col("sigs").alias(sigs), F.col("class_id").alias(class_id)).hint("merge")

    compared = (
        candidates.join(sets("x", "sigs_x", "a"), "x").join(sets("y", "sigs_y", "b"), "y")
        .withColumn("likeness", likeness(F.col("sigs_x"), F.col("sigs_y")))
        .filter(F.col("likeness") >= threshold)
    )
    return staging.write(compared.select("x", "y", "a", "b", "likeness"), "links")


def _split_join(spread: DataFrame, frequency: DataFrame, hot: DataFrame) -> DataFrame:
    """Signatures of sets with their frequency; hot ones, at most ``1 / _HOT``, by broadcast."""
    named = F.broadcast(hot.withColumnRenamed("df", "hot_df"))
    marked = spread.join(named, "sig", "left")
    cold = frequency.join(F.broadcast(hot.select("sig")), "sig", "left_anti")
    few = marked.filter("hot_df IS NOT NULL").withColumnRenamed("hot_df", "df")
    return few.unionByName(marked.filter("hot_df IS NULL").drop("hot_df").join(cold.hint("merge"), "sig"))


def alike_pairs(
    docs: DataFrame, *, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD
) -> tuple[DataFrame, DataFrame]:
    """(pairs, members): pairs ``(a, b, likeness)`` of classes alike, and ``(doc_id, class_id)``.

    A class holds all documents with one signature set and is named by its smallest id; pairs are
    those of ``class_links``, so copies are not expanded. Documents without id or without a
    signature have no class and no pair.
    """
    staging = Staging.of(docs)
    plain = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    classes = signature_classes(plain, staging)
    links = class_links(classes, staging, threshold)
    signed = plain.filter("doc_id IS NOT NULL").select(
        "doc_id", signatures(F.col("text")).alias("sigs")
    ).filter(F.size("sigs") > 0)
    members = _with_class(signed, classes.select("set", "class_id"), classes).select("doc_id", "class_id")
    return links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "likeness"), members
