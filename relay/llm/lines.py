"""Line deduplication by an exact set-similarity join, in DataFrame functions only.

A line is the set of its 5-word shingles, in lower case; a shorter line is one shingle,
a line without words has none and always stays. A line goes if the Jaccard similarity
of its set with that of an earlier line, in the order of (doc_id, line), is 0.75 or
more.

1. Shingles are counted over the whole corpus, in RANKS counters they are hashed to.
   Rare shingles come first in each set: a token is the rank of its counter, then its
   hash, so that sets sort by rarity.
2. Lines of the same shingles in the same order are one class, with the place of its
   first line. They are combined before the shuffle, so a line that stands in a third
   of all documents is one row per task.
3. Two sets that are similar enough share a token among the first n - ceil(0.75 n) + 1
   (prefix filter), have similar sizes (length filter), and leave room behind that
   token for the overlap that is needed (positional filter). Tokens of only one class
   can join nothing and go first.
4. One earlier similar class is enough. So in turns each token has one centre, every
   class that is still open is compared with the earlier centre it shares most tokens
   with, and those that match leave. A turn makes at most one pair a class, and a few
   turns settle a group of near copies. When turns settle little, the classes still
   open are compared with all earlier ones that pass the filters.
5. A class with an earlier similar class loses all its lines, any other all but its
   first. Documents of which no line goes are not shuffled at all.

Null and empty texts stay as they are. A document that repeats (equal doc_id and text)
keeps the lines of each row alike. Lines of a null doc_id are neither compared nor
removed. Other columns are kept; an empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from relay.llm.common import fresh
from relay.llm.sieve import constant_array, sieve
from relay.session import stage

SHINGLE = 5
PERCENT = 75
RANKS = 1 << 16
# Bits of a shingle's hash in a token, below its rank. Equal tokens of unlike shingles only
# give more candidates: classes and verification have all 64 bits.
HASH_BITS = 47
# Words of the bit map of shared tokens: about two tokens a KB of text, so the one for sets
# of documents is full where this one still rules out most rows.
TOKEN_SIEVE = 1 << 20
# More turns save pairs of the last step and do not change the result.
TURNS = 6
YIELD = 0.05


def words_of(line: Column) -> Column:
    """Words of a line; none is an empty one."""
    plain = F.lower(line)
    for blank in "\t\v\f\r":
        plain = F.replace(plain, F.lit(blank), F.lit(" "))
    return once(F.split(plain, " "), lambda w: F.when(
        F.array_contains(w, ""), F.filter(w, lambda x: x != "")).otherwise(w))


def once(value: Column, then: Callable[[Column], Column]) -> Column:
    """An expression over a value that is computed once, however often it is used: the
    value is bound as the variable of a lambda, so nothing is copied into a row."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def shingles_of(line: Column) -> Column:
    """64-bit hashes of the 5-word shingles of a line in order."""
    def runs(w: Column) -> Column:
        several = F.transform(F.sequence(F.lit(0), F.greatest(F.size(w) - SHINGLE, F.lit(0))), lambda i: F.xxhash64(
            *[F.get(w, i + k) for k in range(SHINGLE)]))
        whole = F.array(F.xxhash64(w))
        return (F.when(F.size(w) >= SHINGLE, several).when(F.size(w) > 0, whole)
                .otherwise(F.array().cast("array<bigint>")))

    return once(words_of(line), runs)


def lines_of(docs: DataFrame) -> DataFrame:
    return (docs.filter("doc_id IS NOT NULL")
            .select(F.col("doc_id").cast("long").alias("doc_id"), F.posexplode(F.split("text", "\n")).alias("no", "line")))


def ranks(lines: DataFrame) -> Column:
    """The ranks of all counters as a constant array: 0 for the rarest, shifted to where a
    token has them. The aggregate, and so the array, has RANKS entries at any size."""
    counter = F.col("s").bitwiseAND(RANKS - 1)
    counted = (lines.select(F.explode(shingles_of(F.col("line"))).alias("s"))
               .groupBy(counter.cast("int").alias("at")).count())
    # Counters that nothing is hashed to are looked up by nothing.
    order = F.row_number().over(Window.orderBy("count", "at")) - 1
    return constant_array(counted.select("at", F.shiftleft(order.cast("long"), HASH_BITS).alias("value")),
                          RANKS, "line-ranks")


def prefix_size(n: Column) -> Column:
    return (n - F.ceil(n * PERCENT / 100) + 1).cast("int")


def keyed(lines: DataFrame, table: Column) -> DataFrame:
    """Per line its place and `k`: hashes h1 and h2 of its shingles, n of them, and the
    prefix: tokens (rank in the high bits, hash in the low ones), rarest first."""
    low = F.lit((1 << HASH_BITS) - 1).cast("long")

    def key(s: Column, rank: Column) -> Column:
        n = F.size(s)
        every = F.sort_array(F.transform(s, lambda x: F.get(rank, x.bitwiseAND(RANKS - 1).cast("int")).bitwiseOR(
            x.bitwiseAND(low))))
        prefix = F.slice(every, F.lit(1), prefix_size(n))
        return F.struct(F.xxhash64(s).alias("h1"), F.hash(s).alias("h2"), n.alias("n"), prefix.alias("prefix"))

    # A subquery must not stand inside a lambda when a plan is analysed; the optimizer puts
    # the column, which is used once, where it is needed and so copies it into no row.
    both = F.struct(F.array_distinct(shingles_of(F.col("line"))).alias("s"), F.col("rank"))
    return (lines.select("doc_id", "no", "line", table.alias("rank"))
            .select("doc_id", "no", once(both, lambda x: key(x["s"], x["rank"])).alias("k")))


def classes_of(keys: DataFrame) -> DataFrame:
    """Lines of the same shingles in the same order, with the place (doc, no) of the first
    one and the number of lines."""
    kinds = keys.groupBy("h1", "h2", "n").agg(F.min(F.struct("doc_id", "no")).alias("first"),
                                              F.count("*").alias("lines"), F.first("prefix").alias("prefix"))
    return kinds.select("h1", "h2", "n", "lines", F.col("first.doc_id").alias("doc"), F.col("first.no").alias("no"),
                        "prefix")


def token_rows(keys: DataFrame) -> DataFrame:
    return shared_rows(stage(classes_of(keys), "line-classes"))


def shared_rows(classes: DataFrame) -> DataFrame:
    """(doc, no, n, i, token, bin) for each prefix token of a class that another class has,
    too; doc and no are the place of the class, i that of the token, bin a size class."""
    rows = classes.select("doc", "no", "n", F.posexplode("prefix").alias("i", "token"))
    shared = stage(rows.groupBy("token").agg(F.count("*").alias("c")).filter("c > 1").select("token"), "line-shared")
    size = F.floor(F.log("n") / F.log(F.lit(100 / PERCENT))).cast("int")
    return (rows.filter(sieve(shared, "token", TOKEN_SIEVE)).join(shared, "token", "left_semi")
            .withColumn("bin", size))


def passing() -> Column:
    """Whether rows a and b of one token pass the filters, a being the earlier one."""
    small, large = F.least("a.n", "b.n"), F.greatest("a.n", "b.n")
    needed = F.ceil((F.col("a.n") + F.col("b.n")) * PERCENT / (100 + PERCENT))
    room = F.least(F.col("a.n") - F.col("a.i"), F.col("b.n") - F.col("b.i"))
    earlier = (F.col("a.doc") < F.col("b.doc")) | ((F.col("a.doc") == F.col("b.doc")) & (F.col("a.no") < F.col("b.no")))
    return earlier & (100 * small >= PERCENT * large) & (room >= needed)


def met(joined: DataFrame) -> DataFrame:
    """Pairs of classes (first places a before b) and the number of tokens they met in."""
    return joined.groupBy(F.col("a.doc").alias("doc_a"), F.col("a.no").alias("no_a"),
                          F.col("b.doc").alias("doc_b"), F.col("b.no").alias("no_b")).agg(F.count("*").alias("met"))


def best(pairs: DataFrame) -> DataFrame:
    """Of each class b the pair with the earlier class it shares most prefix tokens with."""
    return pairs.groupBy("doc_b", "no_b").agg(
        F.max_by(F.struct("doc_a", "no_a"), F.struct("met", "doc_a", "no_a")).alias("a")).select(
        "a.doc_a", "a.no_a", "doc_b", "no_b")


def with_centres(rows: DataFrame, open_rows: DataFrame, turn: int) -> DataFrame:
    """Pairs of open classes with centres: in each token and size class the earliest class
    first, then the first one in an order that changes with the turn."""
    order = F.lit(0).cast("long") if turn == 0 else F.xxhash64("doc", "no", F.lit(turn))
    centre = rows.groupBy("token", "bin").agg(F.min(F.struct(order.alias("o"), "doc", "no", "n", "i")).alias("c"))
    centre = centre.select("token", "bin", "c.doc", "c.no", "c.n", "c.i")
    same = (F.col("a.token") == F.col("b.token")) & (F.col("a.bin") == F.col("b.bin"))
    return best(met(centre.alias("a").join(open_rows.alias("b"), same & passing())))


def with_all(rows: DataFrame, open_rows: DataFrame) -> DataFrame:
    """Pairs of open classes with all earlier ones that pass the filters."""
    return met(rows.alias("a").join(open_rows.alias("b"), (F.col("a.token") == F.col("b.token")) & passing()))


def possible(rows: DataFrame, pairs: DataFrame) -> DataFrame:
    """Those pairs that all their shared tokens leave possible.

    The tokens of the prefix that ends first are all either in the other prefix or not in
    the other set at all, so those must not be more than a similar set can lack.
    """
    held = rows.groupBy("doc", "no", "n").agg(F.collect_list("token").alias("t"))
    first = held.select(F.col("doc").alias("doc_a"), F.col("no").alias("no_a"), F.col("n").alias("na"), F.col("t").alias("ta"))
    second = held.select(F.col("doc").alias("doc_b"), F.col("no").alias("no_b"), F.col("n").alias("nb"), F.col("t").alias("tb"))
    needed = F.ceil((F.col("na") + F.col("nb")) * PERCENT / (100 + PERCENT))

    def lacks(n: str) -> Column:
        return prefix_size(F.col(n)) - F.col("common") <= F.col(n) - needed

    return (pairs.join(first, ["doc_a", "no_a"]).join(second, ["doc_b", "no_b"])
            .withColumn("common", F.size(F.array_intersect("ta", "tb")))
            .filter(lacks("na") | lacks("nb")).select(pairs.columns))


def verified(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """Places (doc_id, no) of those b whose whole set is similar enough to that of a."""
    places = (pairs.select(F.col("doc_a").alias("doc_id"), F.col("no_a").alias("no"))
              .unionByName(pairs.select(F.col("doc_b").alias("doc_id"), F.col("no_b").alias("no"))).distinct())
    needed = stage(places.groupBy("doc_id").agg(F.collect_set("no").alias("nos")), "line-places")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").filter(sieve(needed))
    cut = (texts.join(needed, "doc_id").select("doc_id", F.explode("nos").alias("no"), F.split("text", "\n").alias("all"))
           .select("doc_id", "no", F.get("all", F.col("no")).alias("line")))
    # Rows that repeat a doc_id with other texts may lack the line.
    sets = stage(cut.filter("line IS NOT NULL").select(
        "doc_id", "no", F.array_distinct(shingles_of(F.col("line"))).alias("s")), "line-sets")
    first = sets.select(F.col("doc_id").alias("doc_a"), F.col("no").alias("no_a"), F.col("s").alias("sa"))
    second = sets.select(F.col("doc_id").alias("doc_b"), F.col("no").alias("no_b"), F.col("s").alias("sb"))
    common = F.size(F.array_intersect("sa", "sb"))
    return (pairs.join(first, ["doc_a", "no_a"]).join(second, ["doc_b", "no_b"])
            .withColumn("common", common)
            .filter(100 * F.col("common") >= PERCENT * (F.size("sa") + F.size("sb") - F.col("common")))
            .select(F.col("doc_b").alias("doc_id"), F.col("no_b").alias("no")).distinct())


def matched(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """Places of the classes that any earlier class matches."""
    found, open_rows = None, rows
    for turn in range(TURNS):
        pairs = stage(with_centres(rows, open_rows, turn), "line-centres")
        hits = stage(verified(docs, stage(possible(rows, pairs), "line-possible")), "line-found")
        found = hits if found is None else found.unionByName(hits)
        gone = found.select(F.col("doc_id").alias("doc"), "no")
        open_rows = rows.join(gone, ["doc", "no"], "left_anti")
        if hits.count() <= YIELD * pairs.count():
            break
    pairs = stage(possible(rows, with_all(rows, open_rows)), "line-pairs")
    first = stage(best(pairs), "line-best")
    hits = stage(verified(docs, first), "line-found")
    done = hits.select(F.col("doc_id").alias("doc_b"), F.col("no").alias("no_b"))
    rest = pairs.join(done, ["doc_b", "no_b"], "left_anti").join(first, ["doc_a", "no_a", "doc_b", "no_b"], "left_anti")
    return found.unionByName(hits).unionByName(verified(docs, stage(rest, "line-rest")))


def removals(docs: DataFrame) -> DataFrame:
    """Places (doc_id, no) of all lines that go."""
    lines = lines_of(docs)
    keys = stage(keyed(lines, ranks(lines)), "line-keys").select("doc_id", "no", "k.*").filter("n > 0")
    classes = stage(classes_of(keys), "line-classes")
    gone = stage(matched(docs, stage(shared_rows(classes), "line-tokens")).select(
        F.col("doc_id").alias("doc"), "no", F.lit(True).alias("gone")).distinct(), "line-matched")
    judged = classes.drop("prefix").join(gone, ["doc", "no"], "left").withColumn("gone", F.col("gone").isNotNull())
    # A class of one line that nothing matches loses nothing.
    loses = judged.filter("gone OR lines > 1").withColumnRenamed("no", "first_no")
    lost = (keys.drop("prefix").join(loses, ["h1", "h2", "n"])
            .filter("gone OR doc_id <> doc OR no <> first_no").select("doc_id", "no").distinct())
    # Rows that repeat a doc_id with other texts may have the first line of another class there.
    stay = judged.filter("NOT gone").select(F.col("doc").alias("doc_id"), "no")
    return lost.join(stay, ["doc_id", "no"], "left_anti")


def deduplicate(docs: DataFrame) -> DataFrame:
    """The documents with the remaining lines in `text`; n_lines and n_removed are added
    (replaced, if there are such columns), all other columns and rows stay."""
    doc, numbers = fresh("_doc", docs), fresh("_gone", docs)
    gone = stage(removals(docs).groupBy(F.col("doc_id").alias(doc)).agg(F.collect_set("no").alias(numbers)),
                 "line-removals")
    touched = F.coalesce(sieve(gone.select(F.col(doc).alias("doc_id"))), F.lit(False))
    pieces = F.split("text", "\n")
    # The sieve lets some documents through that lose no line.
    left = F.when(F.col(numbers).isNull(), pieces).otherwise(
        F.filter(pieces, lambda x, i: ~F.array_contains(F.col(numbers), i)))
    known = docs.withColumns({"n_lines": F.coalesce(F.size(pieces), F.lit(0)), "n_removed": F.lit(0)})
    known = known.withColumn("n_lines", F.greatest("n_lines", F.lit(0)))
    changed = (known.filter(touched).join(gone, F.col("doc_id").cast("long") == F.col(doc), "left")
               .withColumns({"n_removed": F.coalesce(F.size(pieces) - F.size(left), F.lit(0)),
                             "text": F.coalesce(F.array_join(left, "\n"), "text")}).drop(doc, numbers))
    return changed.unionByName(known.filter(~touched))
