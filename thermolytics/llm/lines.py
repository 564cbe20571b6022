"""Line dedup by a log-template tree (DataFrame functions only).

Lines (cut at line feeds) are parsed to a fixed depth. The first level of the tree is the
number of words, the next ``DEPTH`` levels are the leading words, where a word that holds an
ASCII digit counts as a variable field ``<*>``. In a leaf, a word stays constant at its
position if lines with it there have a support of ``min_docs``; any other word is a variable
field as well. The constant words and fields make the line's template. A template with
``min_docs`` of support and with at least ``MIN_CONST`` of its words without digits constant
(``LEAST_CONST`` words in any case) is recurring, and its lines are dropped from every document.

Support counts documents in which a line stands in different surroundings: of all places of a
(masked) line with one pair of neighbour lines only the smallest doc_id counts, and the support
is the number of such ids. Inside a block of several lines, or between blank ones, the neighbours
are the same everywhere, so lines with ``min_docs`` places are counted by their documents as well
(unless ``by_document`` is off), and the larger number holds. Documents are told apart by the
lines with fewer places, as a set; one with more than half of its words on lines with ``min_docs``
places is a copy, told apart by the smallest hash of these lines only, so a group of near copies
counts a few times at most. So boilerplate has a support near its document count. A line repeated within one document has one,
and so have the lines of a document that was copied whole, however often: copies are left to
near-duplicate removal.

Counts are partial sums over distinct masked lines, by hash, so a line that fills a third of
the table is one row per task in its first shuffle.

Lines of fewer than ``MIN_WORDS`` words have no template: they recur by chance alone.

Cases: null text stays null, with no lines. Blank lines stay. Null ids support nothing.
Words are separated by space, tab, VT, FF and CR. Equal rows get equal results. An empty
table gives an empty result; other columns of documents are kept as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize, release
from .common import WORD, free_name, row_key

DEPTH = 3
MIN_DOCS = 20
MIN_CONST = 0.7         # of the words without a digit
LEAST_CONST = 2
MIN_WORDS = 3
BROADCAST_ROWS = 1_000_000  # leaves, 8 bytes each
FIELD = "<*>"


def mask(line: Column) -> Column:
    """The line's words joined by one space, words with a digit as ``<*>``.

    Most lines are their own mask: one scan for a digit or a space out of place settles that.
    """
    words = F.regexp_extract_all(line, F.lit(f"({WORD})"), F.lit(1))
    masked = F.regexp_replace(F.array_join(words, " "), r"[^ ]*[0-9][^ ]*", FIELD)
    odd = F.rlike(line, F.lit(r"[0-9\x09-\x0D]")) | F.contains(line, F.lit("  ")) \
        | F.startswith(line, F.lit(" ")) | F.endswith(line, F.lit(" "))
    return F.when(odd, masked).otherwise(line)


def n_words(masked: str = "masked") -> Column:
    return F.length(masked) - F.length(F.replace(F.col(masked), F.lit(" "), F.lit(""))) + 1


def n_fields(masked: str = "masked") -> Column:
    return (F.length(masked) - F.length(F.replace(F.col(masked), F.lit(FIELD), F.lit("")))) / len(FIELD)


def leaf(masked: str = "masked", depth: int = DEPTH) -> Column:
    """Place in the tree: number of words and leading words."""
    return F.xxhash64(n_words(masked), F.substring_index(masked, " ", depth))


def _masked(docs: DataFrame) -> DataFrame:
    return docs.select(row_key().alias("key"), "doc_id", F.transform(F.split("text", "\n"), mask).alias("masked"))


def numbered_lines(docs: DataFrame, depth: int = DEPTH) -> DataFrame:
    """One row per non-blank line, ``n`` from 0: (key, doc_id, n, h, g, leaf, n_words, context).

    h and g are two hashes of the masked line, leaf is that of its place in the tree and
    context that of its two neighbour lines, so that no counting step moves text.
    """
    split = _masked(docs).withColumn("hashes", F.transform("masked", lambda m: F.xxhash64(m)))
    at = split.select("key", "doc_id", "hashes", F.posexplode("masked").alias("n", "masked")).where("masked <> ''")
    side = lambda i: F.coalesce(F.get("hashes", i), F.lit(0))
    return at.select("key", "doc_id", "n", F.get("hashes", F.col("n")).alias("h"), F.xxhash64(F.lit(1), "masked").alias("g"),
                     leaf("masked", depth).alias("leaf"), n_words().alias("n_words"),
                     F.xxhash64(side(F.col("n") - 1), side(F.col("n") + 1)).alias("context"))


def _support(rows: DataFrame, *keys: str) -> DataFrame:
    """Support of each distinct ``keys``: distinct first documents of its contexts; and its places."""
    first = rows.groupBy(*keys, "context").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("places"))
    return first.groupBy(*keys).agg(F.count_distinct("first").alias("support"), F.sum("places").alias("places"))


def _by_document(lines: DataFrame, often: DataFrame) -> DataFrame:
    """(h, g, leaf, apart): support of the lines ``often`` (h) by the documents that they stand in."""
    at = lines.where("doc_id is not null").join(often.withColumn("often", F.lit(True)), "h", "left")
    own = F.col("often").isNull()
    per = at.groupBy("key", "doc_id").agg(
        F.sum(F.when(~own, F.col("n_words"))).alias("common"), F.sum("n_words").alias("words"),
        F.min(F.when(~own, F.col("h"))).alias("low"), F.bit_xor(F.when(own, F.col("h"))).alias("rest"),
        F.collect_set(F.when(~own, F.struct("h", "g", "leaf"))).alias("held"))      # bounded by one document's lines
    told = F.when(F.col("common") * 2 > F.col("words"), F.xxhash64(F.lit(0), "low")).otherwise(F.xxhash64(F.lit(1), "rest"))
    rows = per.select("doc_id", told.alias("context"), F.explode("held").alias("line")).select("doc_id", "context", "line.*")
    return _support(rows, "h", "g", "leaf").select("h", "g", "leaf", F.col("support").alias("apart"))


def recurring_lines(docs: DataFrame, lines: DataFrame, min_docs: int = MIN_DOCS, min_const: float = MIN_CONST,
                    depth: int = DEPTH, by_document: bool = True) -> DataFrame:
    """(h, g, masked, template, template_support) of the distinct masked lines whose template recurs.

    ``lines`` are the numbered lines of ``docs``.
    """
    support = materialize(_support(lines.where(F.col("n_words") >= MIN_WORDS), "h", "g", "leaf"), "lines-support")
    if by_document:
        often, n = materialize(support.where(F.col("places") >= min_docs).select("h").distinct(), "lines-often", count=True)
        apart = _by_document(lines, F.broadcast(often) if n <= BROADCAST_ROWS else often)
        support = materialize(support.join(apart, ["h", "g", "leaf"], "left")
                              .withColumn("support", F.greatest("support", "apart")), "lines-apart")
    support = support.select("h", "g", "leaf", "support")
    leaves = support.groupBy("leaf").agg(F.sum("support").alias("n")).where(F.col("n") >= min_docs).select("leaf")
    leaves, n = materialize(leaves, "lines-leaves", count=True)
    if n <= BROADCAST_ROWS:
        leaves = F.broadcast(leaves)
    busy = support.join(leaves, "leaf", "left_semi")
    texts = _masked(docs).select(F.explode("masked").alias("masked")).where("masked <> ''") \
        .withColumn("leaf", leaf("masked", depth)).join(leaves, "leaf", "left_semi") \
        .select(F.xxhash64("masked").alias("h"), F.xxhash64(F.lit(1), "masked").alias("g"), "masked").distinct()
    busy = materialize(busy.join(texts, ["h", "g"]), "lines-busy")
    words = busy.select("leaf", "h", "g", "support", F.posexplode(F.split("masked", " ")).alias("p", "word"))
    constant = words.groupBy("leaf", "p", "word").agg(F.sum("support").alias("n")) \
        .where((F.col("n") >= min_docs) & (F.col("word") != FIELD)).select("leaf", "p", "word")
    kept = words.join(constant, ["leaf", "p", "word"]) \
        .groupBy("leaf", "h", "g") \
        .agg(F.sort_array(F.collect_list(F.struct("p", "word"))).alias("constants"))    # of one line
    templates = busy.join(kept, ["leaf", "h", "g"]) \
        .where((F.size("constants") >= LEAST_CONST)
               & (F.size("constants") >= min_const * (n_words() - n_fields()))) \
        .withColumn("template", F.concat_ws(" ", n_words(), F.transform(
            "constants", lambda c: F.concat(c["p"], F.lit("="), c["word"]))))
    often = templates.groupBy("template").agg(F.sum("support").alias("template_support")) \
        .where(F.col("template_support") >= min_docs)
    return templates.join(often, "template").select("h", "g", "masked", "template", "template_support")


def dropped_lines(docs: DataFrame, min_docs: int = MIN_DOCS, min_const: float = MIN_CONST,
                  depth: int = DEPTH, by_document: bool = True) -> DataFrame:
    """(key, dropped): the numbers, ascending, of each row's recurring lines; rows without any are left out."""
    lines = materialize(numbered_lines(docs, depth), "lines")
    recurring = recurring_lines(docs, lines, min_docs, min_const, depth, by_document).select("h", "g")
    dropped = lines.select("key", "n", "h", "g").join(recurring, ["h", "g"], "left_semi") \
        .groupBy("key").agg(F.sort_array(F.collect_set("n")).alias("dropped"))      # bounded by one document's lines
    dropped = materialize(dropped, "lines-dropped")
    release(lines)
    return dropped


def dedup_lines(docs: DataFrame, min_docs: int = MIN_DOCS, min_const: float = MIN_CONST,
                depth: int = DEPTH, by_document: bool = True) -> DataFrame:
    """``docs`` with recurring lines taken out of text, plus n_lines and n_dropped.

    The two counts take other names (a trailing underscore) where docs has such columns.
    """
    key, gone = free_name(docs, "_key"), free_name(docs, "_dropped")
    n_lines, n_dropped = free_name(docs, "n_lines"), free_name(docs, "n_dropped")
    out = dropped_lines(docs, min_docs, min_const, depth, by_document).select(F.col("key").alias(key), F.col("dropped").alias(gone))
    lines = F.split("text", "\n")
    # One flag per line up to the last dropped one: linear also in documents of very many lines.
    flags = F.flatten(F.transform(gone, lambda x, i: F.concat(
        F.array_repeat(F.lit(False), x - F.coalesce(F.get(gone, i - 1), F.lit(-1)) - 1), F.array(F.lit(True)))))
    kept = F.filter(F.zip_with(lines, flags, lambda x, f: F.when(f, None).otherwise(x)), lambda x: x.isNotNull())
    left = F.array_join(kept, "\n")
    # The list of documents with drops grows with the documents: a shuffle join at every size.
    return docs.withColumn(key, row_key()).join(out.hint("shuffle_hash"), key, "left") \
        .withColumn(n_lines, F.when(F.col("text").isNull(), 0).otherwise(F.size(lines))) \
        .withColumn(n_dropped, F.coalesce(F.size(gone), F.lit(0))) \
        .withColumn("text", F.when(F.col(gone).isNull(), F.col("text")).otherwise(left)) \
        .select(*docs.columns, n_lines, n_dropped)
