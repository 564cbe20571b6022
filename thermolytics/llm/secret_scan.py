"""Secret scan with corpus-wide ownership frequency (DataFrame functions only).

Candidates are found in each text by patterns: the base kinds ``assign``, ``access`` and ``hex``, and
``owned``, runs of letters and digits that look random and do not touch a base span. Their values,
as hashes, are then summed over the whole corpus by distinct repositories (documents) and distinct
owners (sources). A value that stands with ``WIDE_OWNERS`` owners, or with two and in
``WIDE_REPOSITORIES`` documents, is widely copied: an example, a test vector, a licence key of
everybody. Base spans stay either way and say whether their value is copied; an ``owned`` candidate
is a finding only if its value is specific to its owners.

Positions come from splitting the text at marks set round the matches, so they are code points.
No text and no value leaves the scan of its row: rows of the later steps hold positions and hashes.

Skew: a value that stands in a third of all documents is counted by partial sums. Of the verdicts,
those of values with more than a fixed share of all spans are broadcast, of which there are at most
``4 * slots`` by their definition; so the join by value meets bounded groups only.

Cases: null text is empty. The null source is an owner of its own. A failing base match (value too
short) still uses up its text. Marks that stand in a text themselves count as characters that no
pattern takes. Equal rows get equal results and are one repository. An empty table gives an empty
result; columns other than doc_id, text and source are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import row_key, slots

KINDS = ("assign", "access", "hex", "owned")        # in the order of spans that start together
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_LEAST = 6                                    # characters of the assigned value
ACCESS = r"AKIA[A-Z0-9]{16,}+"                      # a run that is too short has no longer match inside
HEX = r"[0-9a-f]{24,}+"
RUN = r"[0-9A-Za-z]{20,}+"
RUN_CHARS, RUN_DIGITS, RUN_LETTERS = 10, 3, 3       # distinct characters, digits and letters of an ``owned`` run
WIDE_OWNERS = 3
WIDE_REPOSITORIES = 20
MARK, FILL, OTHER = "\u0001", "\u0002", "\u0003"    # round a match, instead of a found span, instead of both in a text
BLOCK = 256


def _starts(df: DataFrame, parts: str, name: str) -> DataFrame:
    """``df`` with ``name``: the code points before each entry of ``parts``, null where there is no match.

    Sums go by blocks, so that the work is linear in the number of parts. Each step is a column of its
    own, because a lambda would work out again what it refers to.
    """
    total = lambda a: F.aggregate(a, F.lit(0).cast("long"), lambda s, x: s + x)
    lens = F.when(F.size(parts) > 1, F.transform(parts, lambda p: F.length(p).cast("long")))
    last = F.ceil(F.size("_lens") / F.lit(BLOCK)).cast("int") - 1
    df = df.withColumn("_lens", lens) \
        .withColumn("_blocks", F.transform(F.sequence(F.lit(0), last), lambda b: F.slice("_lens", b * BLOCK + 1, F.lit(BLOCK)))) \
        .withColumn("_sums", F.transform("_blocks", total)) \
        .withColumn("_before", F.transform("_sums", lambda _, b: total(F.slice("_sums", F.lit(1), b))))
    return df.withColumn(name, F.flatten(F.zip_with("_blocks", "_before", lambda block, before: F.transform(
        block, lambda _, i: before + total(F.slice(block, F.lit(1), i)))))) \
        .drop("_lens", "_blocks", "_sums", "_before")


def _marked(text: str, pattern: str) -> Column:
    """The text cut round the matches of ``pattern``: every second part, from the second on, is a match."""
    return F.split(F.regexp_replace(text, F.lit(pattern), F.lit(f"{MARK}$0{MARK}")), MARK)


def _found(df: DataFrame, column: str, pattern: str, kind: str, value, fits) -> DataFrame:
    """``df`` with an array column ``kind`` of (start, rank, end, h, g): matches of ``pattern`` in ``column``.

    ``value(match)`` is what is secret of a match, ``fits(parts, i)`` says whether match ``i`` counts.
    """
    df = _starts(df.withColumn("_parts", _marked(column, pattern)), "_parts", "_at")
    part = lambda i: F.get("_parts", i)
    odd = F.filter(F.sequence(F.lit(1), F.size("_parts") - 1), lambda i: i % 2 == 1)
    kept = F.filter(odd, lambda i: fits(part, i))
    spans = F.transform(kept, lambda i: F.struct(
        F.get("_at", i).alias("start"), F.lit(KINDS.index(kind)).alias("rank"),
        (F.get("_at", i) + F.length(part(i))).alias("end"),
        F.xxhash64(value(part(i))).alias("h"), F.xxhash64(F.lit(1), value(part(i))).alias("g")))
    none = F.array().cast("array<struct<start:long,rank:int,end:long,h:long,g:long>>")
    return df.withColumn(kind, F.when(F.size("_parts") > 1, spans).otherwise(none)).drop("_parts", "_at")


def _filled(df: DataFrame, pattern: str, kind: str, fits) -> DataFrame:
    """``df`` with the matches of ``pattern`` in column ``masked`` overwritten, length for length. Texts
    without a span of ``kind`` have none in what is left of them either."""
    df = df.withColumn("_parts", F.when(F.size(kind) > 0, _marked("masked", pattern)))
    full = F.array_join(F.transform("_parts", lambda p, i: F.when((i % 2 == 1) & fits(p), F.repeat(F.lit(FILL), F.length(p)))
                                    .otherwise(p)), "")
    return df.withColumn("masked", F.coalesce(full, "masked")).drop("_parts")


def _assigned(match: Column) -> Column:
    return F.regexp_extract(match, ASSIGN, 2)


def _random_looking(part, i: Column) -> Column:
    """A run of many different characters with digits and letters that touches no base span."""
    run = part(i)
    count = lambda cls: F.length(F.regexp_replace(run, F.lit(cls), F.lit("")))
    alone = ~F.endswith(part(i - 1), F.lit(FILL)) & ~F.startswith(F.coalesce(part(i + 1), F.lit("")), F.lit(FILL))
    return alone & (F.size(F.array_distinct(F.split(run, ""))) >= RUN_CHARS) \
        & (count("[^0-9]") >= RUN_DIGITS) & (count("[0-9]") >= RUN_LETTERS)


def candidates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", owner: str = "source") -> DataFrame:
    """(key, doc_id, owner, assign, access, hex, owned) per row: the spans of each kind, ``owned`` ones undecided."""
    plain = F.replace(F.replace(F.coalesce(F.col(text), F.lit("")), F.lit(MARK), F.lit(OTHER)), F.lit(FILL), F.lit(OTHER))
    df = docs.select(row_key(doc_id, text).alias("key"), F.col(doc_id).alias("doc_id"),
                     F.xxhash64(F.col(owner).isNull(), F.col(owner)).alias("owner"), plain.alias("text"))
    itself = lambda match: match
    always = lambda *_: F.lit(True)
    long_enough = lambda match: F.length(_assigned(match)) >= ASSIGN_LEAST
    df = _found(df, "text", ASSIGN, "assign", _assigned, lambda part, i: long_enough(part(i)))
    df = _found(df, "text", ACCESS, "access", itself, always)
    df = _found(df, "text", HEX, "hex", itself, always)
    df = _filled(df.withColumn("masked", F.col("text")), ASSIGN, "assign", long_enough)
    df = _filled(df, ACCESS, "access", always)
    df = _filled(df, HEX, "hex", always)
    df = _found(df, "masked", RUN, "owned", itself, _random_looking)
    return df.select("key", "doc_id", "owner", *KINDS)


def ownership(spans: DataFrame) -> DataFrame:
    """(h, g, n, owners, repositories, copied) per distinct value of spans (key, owner, h, g)."""
    held = spans.groupBy("h", "g").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("owner").alias("owners"),
                                       F.count_distinct("key").alias("repositories"))
    copied = (F.col("owners") >= WIDE_OWNERS) | ((F.col("owners") >= 2) & (F.col("repositories") >= WIDE_REPOSITORIES))
    return held.withColumn("copied", copied)


def _judged(spans: DataFrame, total: int) -> DataFrame:
    """``spans`` with owners, repositories and copied of their values."""
    verdicts = materialize(ownership(spans), "secrets-values")
    # At most 4 * slots values can hold as many spans as this: a bounded broadcast.
    bar = total // (4 * slots(spans.sparkSession)) + 1
    cols = ["owners", "repositories", "copied"]
    hot = F.broadcast(verdicts.where(F.col("n") >= bar).select("h", "g", F.struct(*cols).alias("verdict")))
    cold = verdicts.where(F.col("n") < bar).select("h", "g", F.struct(*cols).alias("verdict"))
    told = spans.join(hot, ["h", "g"], "left")
    return told.where("verdict is not null") \
        .unionByName(told.where("verdict is null").drop("verdict").join(cold.hint("shuffle_hash"), ["h", "g"])) \
        .select("key", "start", "rank", "end", "verdict.*")


def find_secrets(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", owner: str = "source") -> DataFrame:
    """(doc_id, spans) per row of ``docs``; spans, ordered by start and kind, is an array of
    (start, rank, end, owners, repositories, copied), rank being the place of the kind in ``KINDS``."""
    found = materialize(candidates(docs, doc_id, text, owner), "secrets-found")
    spans = found.select("key", "owner", F.explode(F.concat(*KINDS)).alias("s")).select("key", "owner", "s.*")
    spans, total = materialize(spans, "secrets-spans", count=True)
    judged = _judged(spans, total).where((F.col("rank") < KINDS.index("owned")) | ~F.col("copied"))
    held = judged.groupBy("key").agg(F.array_sort(F.collect_set(F.struct(
        "start", "rank", "end", "owners", "repositories", "copied"))).alias("spans"))   # of one text
    none = F.array().cast(held.schema["spans"].dataType)
    return found.select("key", "doc_id").join(held.hint("shuffle_hash"), "key", "left") \
        .select("doc_id", F.coalesce("spans", none).alias("spans"))


def _of_rank(rank: int):
    return lambda span: span["rank"] == rank


def scan(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n_assign, n_access, n_hex, base_sha256, spans (text), n_owned, n_copied."""
    out = find_secrets(docs)
    name = F.array(*[F.lit(k) for k in KINDS])
    shown = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(name, s["rank"]), s["start"].cast("string"), s["end"].cast("string"))), ",")
    n = lambda f: F.size(F.filter("spans", f)).cast("long")
    return out.select(
        "doc_id", *[n(_of_rank(i)).alias(f"n_{k}") for i, k in enumerate(KINDS)],
        n(lambda s: s["copied"]).alias("n_copied"),
        F.sha2(shown(F.filter("spans", lambda s: s["rank"] < KINDS.index("owned"))), 256).alias("base_sha256"),
        shown(F.col("spans")).alias("spans"))
