"""Line deduplication with a log-template tree (operator 3), in DataFrame operations only.

A line's place in the tree has a fixed depth: its number of tokens, then its leading tokens, in
which every token with a digit is a variable field. Lines at one leaf are generalised to
templates: the commonest token at each position is the candidate, and lines that agree with it
in at least ``SIMILAR`` percent of their positions share the template; the lines left over are
tried again. A leaf whose candidate does not recur is split at a divided position (if there is none,
the candidate's lines are set aside), until a leaf is too small for a recurring template. A line that joins no shared
template is its own. Templates that occur in ``MIN_DOCS`` or more documents, for long lines
in ``LONG_DOCS`` or more, are dropped from all documents but the one with the smallest id, so the
passage itself is not lost. The candidate of long lines is the line in most documents: two lines
have no majority at a position. Words are tokens, or pairs of characters in text without spaces.

Only counts and hashes move for most lines: texts are looked at again just for leaves that
several documents reach by different lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ontime_spark.llm import common
from ontime_spark.session import discard, materialize

#: Documents in which a template must occur to be recurring.
MIN_DOCS = 5
#: The same for long lines, those of more than ``LONG_WORDS`` words.
LONG_DOCS = 2
LONG_WORDS = 50
#: Shorter lines (in words) are left alone: a few common words meet by chance.
MIN_TOKENS = 4
#: Text with more characters than this for each token has no spaces between words.
UNSPACED = 20
#: Leading tokens below the token count.
LEADING = 3
#: Percent of equal positions for a line to share a template.
SIMILAR = 80
FIELD = "<*>"


def _masked(line: Column) -> Column:
    """The line's tokens joined by one space, tokens with a digit replaced by a field."""
    odd = line.contains("  ")
    for c in "\t\x0b\x0c\r":
        odd = odd | line.contains(c)
    spaced = F.when(odd, F.regexp_replace(line, r"[\x20\x09-\x0D]+", " ")).otherwise(line)
    trimmed = F.trim(spaced)
    return F.when(trimmed.rlike("[0-9]"), F.regexp_replace(trimmed, r"(?<![^ ])[^ 0-9]*+[0-9][^ ]*", FIELD)).otherwise(trimmed)


def _lines(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc, version (hash of the text), nth, n (tokens), long, leaf, line (hash) of each line that
    has enough words; and the masked line."""
    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).alias("doc"), F.xxhash64(text).alias("version"),
                       F.posexplode(F.split(text, "\n")).alias("nth", "raw"))
    # The one-element explode is a barrier: the masked line is computed once, not again in each
    # expression and filter that uses it.
    rows = (rows.select("doc", "version", "nth", F.explode(F.array(_masked(F.col("raw")))).alias("masked"))
            .withColumn("n", F.octet_length("masked") - F.octet_length(F.replace("masked", F.lit(" "), F.lit(""))) + 1)
            .where(F.octet_length("masked") > 0))
    # Only octets can be counted for nothing: characters are, where there are enough octets.
    chars = F.when(F.octet_length("masked") > UNSPACED * F.col("n"), F.char_length("masked")).otherwise(0)
    words = F.when(chars > UNSPACED * F.col("n"), F.greatest("n", (chars / 2).cast("int"))).otherwise(F.col("n"))
    rows = rows.withColumn("words", words).where(F.col("words") >= MIN_TOKENS)
    rows = rows.withColumn("long", F.col("words") > LONG_WORDS)
    leaf = F.xxhash64("n", "long", F.substring_index("masked", " ", LEADING)).alias("leaf")
    line = F.xxhash64("masked").alias("line")
    return rows.select("doc", "version", "nth", "n", "long", leaf, line, "masked")


def _tried(open_lines: DataFrame) -> DataFrame:
    """``open_lines`` with fits (the line agrees with its leaf's candidate) and part (the line's
    token where its leaf is split if the candidate does not recur; null if no position divides).

    A leaf is split where its commonest token has at most ``SIMILAR`` percent of the weight, of
    such positions at the one with the fewest tokens."""
    per = (open_lines.select("leaf", "long", "w", F.posexplode("tokens").alias("at", "token"))
           .groupBy("leaf", "long", "at", "token").agg(F.sum("w").alias("w")))
    at = per.groupBy("leaf", "long", "at").agg(F.max(F.struct("w", "token")).alias("top"),
                                               F.count(F.lit(1)).alias("kinds"), F.sum("w").alias("all"))
    divided = F.when(F.col("top.w") * 100 <= F.col("all") * SIMILAR, F.struct("kinds", "top.w", "at"))
    leaves = at.groupBy("leaf").agg(
        F.array_sort(F.collect_list(F.when(~F.col("long"), F.struct("at", "top.token"))))["token"].alias("p"),
        F.min(divided)["at"].alias("cut"))
    heaviest = (open_lines.where("long").groupBy("leaf")
                .agg(F.max(F.struct("w", "line", "tokens"))["tokens"].alias("whole")))
    leaves = leaves.join(heaviest, "leaf", "left").withColumn("p", F.coalesce("whole", "p"))
    equal = F.aggregate(F.zip_with("tokens", "p", lambda a, b: (a == b).cast("int")), F.lit(0), lambda s, x: s + x)
    return (open_lines.join(leaves, "leaf").withColumn("fits", equal * 100 >= F.size("tokens") * SIMILAR)
            .withColumn("part", F.get("tokens", F.col("cut"))).drop("p", "whole", "cut"))


def _left_over(tried: DataFrame, need: Column) -> DataFrame:
    """The lines to try again: what did not fit, where the candidate recurs or no position divides
    the leaf (its candidate is set aside); else all, in one leaf for each token of the split.
    Leaves that cannot hold another shared template are left out."""
    split = F.col("found").isNull() & F.col("part").isNotNull()
    rest = (tried.where(split | ~F.col("fits"))
            .withColumn("leaf", F.when(split, F.xxhash64("leaf", "part")).otherwise(F.col("leaf")))
            .drop("fits", "part", "found"))
    worth = (rest.groupBy("leaf", "long").agg(F.sum("w").alias("c"), F.count(F.lit(1)).alias("n_lines"))
             .where((F.col("c") >= need) & (F.col("n_lines") > 1)).select("leaf"))
    return rest.join(worth, "leaf", "left_semi")


def templates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              min_docs: int = MIN_DOCS, long_docs: int = LONG_DOCS) -> tuple[DataFrame, DataFrame]:
    """(lines, recurring): ``lines`` as doc, version, nth, n, line; ``recurring`` as line,
    template, n_docs, first_doc for the lines whose template is recurring."""
    need = F.when(F.col("long"), long_docs).otherwise(min_docs)
    masked = materialize(_lines(docs, id_col, text_col), "masked-lines")
    lines = materialize(masked.drop("masked"), "lines")
    seen = materialize(lines.select("leaf", "long", "line", "doc").distinct(), "line-docs")
    crowded = (seen.groupBy("leaf", "long").agg(F.count("line").alias("c"), F.min("line").alias("lo"), F.max("line").alias("hi"))
               .where((F.col("c") >= need) & (F.col("lo") != F.col("hi"))).select("leaf"))
    crowded = materialize(crowded, "crowded")  # of known size: texts move only if it is large
    seen_open = materialize(seen.join(crowded, "leaf", "left_semi"), "open-docs")
    weight = seen_open.groupBy("leaf", "long", "line").agg(F.count(F.lit(1)).alias("w"))
    texts = (masked.select("leaf", "line", "masked")
             .join(crowded, "leaf", "left_semi").groupBy("line").agg(F.first("masked").alias("masked")))
    open_lines = materialize(weight.join(texts, "line")
                             .select("leaf", "long", "line", "w", F.split("masked", " ").alias("tokens")), "open-lines")
    discard(masked, crowded)  # the texts of other lines are not looked at again
    shared: DataFrame | None = None
    found_in: list[DataFrame] = []
    # No turn is numbered in the plans: each turn runs the code that the first one compiled.
    while not open_lines.isEmpty():
        tried = materialize(_tried(open_lines), "tried")
        fitting = tried.where("fits").select("leaf", "long", "line")
        # A template is named after its smallest line.
        found = (seen_open.select("line", "doc").join(fitting, "line").groupBy("leaf", "long", "doc").agg(F.min("line").alias("line"))
                 .groupBy("leaf", "long").agg(F.count(F.lit(1)).alias("c"), F.min("line").alias("found")).where(F.col("c") >= need)
                 .select("leaf", "found"))
        fits, tried = tried, materialize(tried.join(found, "leaf", "left"), "found")
        new = tried.where("fits AND found IS NOT NULL").select("line", F.xxhash64("leaf", "found").alias("template"))
        found_in.append(materialize(new, "shared"))
        shared = found_in[-1] if shared is None else shared.union(found_in[-1])
        before, open_lines = open_lines, materialize(_left_over(tried, need), "open-lines")
        discard(before, fits, tried)
    named = seen.select("line", "long", "doc")
    named = (named.withColumn("template", F.col("line")) if shared is None else
             named.join(shared, "line", "left").withColumn("template", F.coalesce("template", "line")))
    recurring = (named.select("template", "long", "doc").distinct().groupBy("template", "long")
                 .agg(F.count(F.lit(1)).alias("n_docs"), F.min("doc").alias("first_doc"))
                 .where(F.col("n_docs") >= need).drop("long"))
    pairs = named.select("line", "template").distinct()
    recurring = materialize(pairs.join(recurring, "template"), "recurring")
    discard(seen, seen_open, open_lines, *found_in)
    return lines.drop("leaf", "long"), recurring


def _dropped(docs: DataFrame, id_col: str, text_col: str, min_docs: int, long_docs: int) -> DataFrame:
    """doc, version, dropped (line numbers), lost (tokens) of the documents that lose lines."""
    lines, recurring = templates(docs, id_col, text_col, min_docs, long_docs)
    return (lines.join(recurring.select("line", "first_doc"), "line")
            .where(~F.col("doc").eqNullSafe(F.col("first_doc")))
            .select("doc", "version", "nth", "n").distinct()
            .groupBy("doc", "version").agg(F.collect_set("nth").alias("dropped"), F.sum("n").alias("lost")))


def drop_recurring(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   min_docs: int = MIN_DOCS, long_docs: int = LONG_DOCS) -> DataFrame:
    """``docs`` with the remaining text and three more columns: n_lines, n_dropped and
    mostly_recurring (more than half of the tokens were dropped).

    Null and empty texts have no lines to drop and stay as they are. Rows of one id count as one
    document; rows without an id count as one document, too. A line repeated inside one document
    only is kept. New columns replace columns of the same name."""
    marks = _dropped(docs, id_col, text_col, min_docs, long_docs)
    # Names that no column of the rows has, for what is joined to them.
    own = {c: common.fresh(docs.columns, f"_{c}") for c in ("hash", "doc", "version", "dropped", "lost")}
    marks = marks.select(*[F.col(c).alias(own[c]) for c in ("doc", "version", "dropped", "lost")])
    text = F.col(text_col).cast("string")
    joined = docs.withColumn(own["hash"], F.xxhash64(text)).join(
        marks, F.col(id_col).eqNullSafe(F.col(own["doc"])) & (F.col(own["hash"]) == F.col(own["version"])), "left")
    split = F.split(text, "\n")
    gone, lost = F.col(own["dropped"]), F.col(own["lost"])
    rest = F.when(gone.isNull(), text).otherwise(F.array_join(
        F.filter(split, lambda x, i: ~F.array_contains(gone, i)), "\n"))
    n_words = F.size(F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda x: x != ""))
    out = [rest.alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns
           if c not in ("n_lines", "n_dropped", "mostly_recurring")]
    return joined.select(
        *out, F.when(F.octet_length(text) > 0, F.size(split)).otherwise(0).cast("long").alias("n_lines"),
        F.when(gone.isNull(), 0).otherwise(F.size(gone)).cast("long").alias("n_dropped"),
        F.when(lost.isNull(), F.lit(False)).otherwise(lost * 2 > n_words).alias("mostly_recurring"))


def cleaned_documents(docs: DataFrame, text_col: str = "text", chars_col: str = "n_chars", **options) -> DataFrame:
    """The documents with their remaining text, without those of which nothing but white space
    remains; columns as they were (``chars_col``, if there, counts the remaining text). The document
    that keeps a recurring line is not empty, so that no line is lost altogether."""
    out = drop_recurring(docs, text_col=text_col, **options)
    out = out.where((F.col("n_dropped") == 0) | F.col(text_col).rlike(r"[^\x20\x09-\x0D]"))
    kept = [F.length(text_col).cast(docs.schema[c].dataType).alias(c) if c == chars_col else F.col(f"`{c}`")
            for c in docs.columns]
    return out.select(*kept)


def op3_line_dedup(spark, sf_dir: str) -> DataFrame:
    """Every document with its lines, dropped lines and a digest of the remaining text."""
    docs = common.read(spark, sf_dir, "documents").select("doc_id", "text")
    out = drop_recurring(docs)
    return out.select("doc_id", "n_lines", "n_dropped", "mostly_recurring",
                      F.length("text").cast("long").alias("n_chars_left"),
                      F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"))
