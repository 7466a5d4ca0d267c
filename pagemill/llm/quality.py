"""Quality rules and a hashed n-gram likelihood ratio.

Every document gets a few counts and a score: the log-likelihood ratio of its hashed words
and word pairs between a trusted multinomial and that of the raw corpus, divided by their number.
Counts and scores are whole numbers, so the verdict does not depend on the order of rows.

A trusted document floats up on its own counts, the more the fewer there are. So it is judged without them, like a
document without a label, and the cut lies where such scores of trusted and of rejected documents part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from pagemill.llm.columns import WHITE, let, whole_text, words_of
from pagemill.session import written

SYMBOL = "[#*$%&|<>]"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
BUCKETS = 1 << 15
# Whole-numbered ids of 64 neighbours share one row of labels, a bit each.
MARK_BITS = 6
# Up to so many rows of labels are broadcast; more of them meet the documents in a shuffle.
BROADCAST_MARKS = 1 << 20
# Scores are natural logarithms in these units.
SCORE_SCALE = 1 << 20
NGRAM = 3
# The cut is looked for among classes of scores of this width, at most this many on either side of 0.
CUT_CLASS = 1 / 1024
CUT_CLASSES = 8192
# Share of rejected documents that the cut has to take for each equal share of trusted ones it loses.
TRUSTED_WEIGHT = 10


def _shift(name: str, value: Column, bits: Column) -> Column:
    return F.call_function(name, value, bits)


def _shared(hashes: Column, positions: Column, bits: Column, part: str) -> Column:
    """Positions whose hash agrees with that of another position in one part of its bits.

    Part of the hash and the position share one long, so the sort is one of plain numbers.
    """
    def packed(p: Column) -> Column:
        h = F.get(hashes, p.cast("int"))
        if part == "high":
            h = _shift("shiftrightunsigned", h, bits)
        return _shift("shiftleft", h, bits).bitwiseOR(p)

    def like(x: Column, other: Column) -> Column:
        return F.coalesce(_shift("shiftrightunsigned", x.bitwiseXOR(other), bits) == 0, F.lit(False))

    def repeats(s: Column) -> Column:
        return F.filter(s, lambda x, i: like(x, F.get(s, i - 1)) | like(x, F.get(s, i + 1)))

    mask = _shift("shiftleft", F.lit(1).cast("long"), bits) - 1
    return F.transform(let(F.sort_array(F.transform(positions, packed)), repeats), lambda x: x.bitwiseAND(mask))


def repeated_words(word_hashes: Column) -> Column:
    """Words inside windows of three that occur at least twice, all their places counted.

    Windows are found by sorting hashes together with their positions, first by the low and
    then, for what is left, by the high bits; both have to agree.
    """
    def covered(places: Column) -> Column:
        steps = F.transform(
            places, lambda p, i: F.least(F.lit(NGRAM).cast("long"), F.coalesce(F.get(places, i + 1) - p, F.lit(NGRAM)))
        )
        return F.aggregate(steps, F.lit(0).cast("long"), lambda total, n: total + n)

    def count(hashes: Column) -> Column:
        every = F.transform(F.sequence(F.lit(0), F.size(hashes) - 1), lambda i: i.cast("long"))

        def places(bits: Column) -> Column:
            rough = _shared(hashes, every, bits, "low")
            return F.sort_array(let(rough, lambda found: _shared(hashes, found, bits, "high")))

        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0).cast("long")).otherwise(
            let(let(F.length(F.bin(F.size(hashes))), places), covered)
        )

    def windows(h: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(h) - NGRAM)
        return F.transform(starts, lambda i: F.xxhash64(F.get(h, i), F.get(h, i + 1), F.get(h, i + 2)))

    return F.when(F.size(word_hashes) < NGRAM, F.lit(0).cast("long")).otherwise(let(windows(word_hashes), count))


def _hashes(words: Column) -> Column:
    return F.transform(words, lambda word: F.xxhash64(word))


def hashed_words(text: Column) -> Column:
    return _hashes(words_of(text))


def buckets_of(word_hashes: Column, buckets: int = BUCKETS) -> Column:
    """Buckets of all words and all pairs of neighbouring words."""
    n_pairs = F.greatest(F.size(word_hashes) - 1, F.lit(0))
    pairs = F.zip_with(
        F.slice(word_hashes, 1, n_pairs), F.slice(word_hashes, 2, n_pairs), lambda a, b: F.xxhash64(a, b)
    )

    def bucket(h: Column) -> Column:
        # The same number as pmod, where the low bits hold it.
        return h.bitwiseAND(buckets - 1) if buckets & (buckets - 1) == 0 else F.pmod(h, F.lit(buckets))

    return F.transform(F.concat(word_hashes, pairs), lambda h: bucket(h).cast("int"))


def _packed(*rows: DataFrame, id_column: str) -> bool:
    return all(isinstance(df.schema[id_column].dataType, T.IntegralType) for df in rows)


def _mark(doc: Column, packed: bool) -> tuple[Column, Column]:
    """The row of labels that an id belongs to, and its bit there."""
    if not packed:
        return doc, F.lit(1).cast("long")
    doc = doc.cast("long")
    return F.shiftright(doc, MARK_BITS), _shift(
        "shiftleft", F.lit(1).cast("long"), doc.bitwiseAND((1 << MARK_BITS) - 1).cast("int")
    )


def label_marks(labels: DataFrame, id_column: str = "doc_id", packed: bool = False) -> DataFrame:
    """``mark, trusted, rejected``: the bits of all good documents and of all documents of low quality."""
    mark, bit = _mark(F.col(id_column), packed)

    def bits(chosen: str) -> Column:
        return F.coalesce(F.bit_or(F.when(F.expr(chosen), bit)), F.lit(0).cast("long"))

    known = labels.where(F.col(id_column).isNotNull()).groupBy(mark.alias("mark"))
    return known.agg(bits("quality = 1 and toxic = 0").alias("trusted"), bits("quality = 0").alias("rejected"))


def _with_labels(rows: DataFrame, marks: DataFrame, packed: bool) -> DataFrame:
    """Add ``is_trusted`` and ``is_rejected`` to rows with the id ``doc``; both are false without a label."""
    mark, bit = _mark(F.col("doc"), packed)
    flags = {
        f"is_{name}": F.coalesce(F.col(name).bitwiseAND(bit) != 0, F.lit(False)) for name in ("trusted", "rejected")
    }
    return rows.join(marks, mark == F.col("mark"), "left").withColumns(flags).drop(*marks.columns)


def ratio_weights(rows: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """One row with the array ``weights``: per bucket the log ratio of its shares, as a whole number.

    Beside it ``good``, the trusted count of each bucket, and ``good_total``. The raw counts cover all ``rows``
    (``hashes, is_trusted``), the trusted ones all trusted rows; one is added to each count.
    """
    counts = (
        rows.select(
            F.col("is_trusted").cast("long").alias("good"),
            F.explode(let(F.col("hashes"), lambda h: buckets_of(h, buckets))).alias("bucket"),
        )
        .groupBy("bucket")
        .agg(F.count(F.lit(1)).alias("raw"), F.sum("good").alias("good"))
    )
    spark = rows.sparkSession
    full = spark.range(buckets).select(F.col("id").cast("int").alias("bucket")).join(counts, "bucket", "left")
    full = full.select("bucket", *[(F.coalesce(c, F.lit(0)) + 1).alias(c) for c in ("raw", "good")])
    # One sorted array of a fixed number of buckets, so this single group is bounded.
    totals = full.agg(
        F.array_sort(F.collect_list(F.struct("bucket", "raw", "good"))).alias("all"),
        F.sum("raw").alias("raw_total"),
        F.sum("good").alias("good_total"),
    )

    def weight(x: Column) -> Column:
        return F.round(
            F.log(x["good"] / F.col("good_total") * F.col("raw_total") / x["raw"]) * SCORE_SCALE
        ).cast("long")

    return totals.select(
        F.transform("all", weight).alias("weights"),
        F.transform("all", lambda x: x["good"]).alias("good"),
        "good_total",
    )


def _whole(value: Column) -> Column:
    """The nearest whole number, halves up; ``round`` would write every value as a decimal."""
    return F.floor(value + 0.5)


def _own_part(buckets: Column) -> Column:
    """What the score of a trusted document loses, before the division, without its own counts in ``good``.

    Each column of the model is named once, else its array would be copied into every row.
    """
    def lost(s: Column) -> Column:
        def run(good: Column, start: Column, end: Column) -> Column:
            n = end - start
            return n * _whole(-F.log1p(-n / F.get(good, F.get(s, start))) * SCORE_SCALE)

        def runs(starts: Column) -> Column:
            parts = let(
                F.col("good"),
                lambda good: F.transform(starts, lambda p, i: run(good, p, F.coalesce(F.get(starts, i + 1), F.size(s)))),
            )
            return F.aggregate(parts, F.lit(0).cast("long"), lambda total, x: total + x)

        places = F.sequence(F.lit(0), F.size(s) - 1)
        firsts = F.filter(places, lambda i: (i == 0) | (F.get(s, F.greatest(i - 1, F.lit(0))) != F.get(s, i)))
        gained = _whole(-F.log1p(-F.size(s) / F.col("good_total")) * SCORE_SCALE)
        return let(firsts, runs) - F.size(s) * gained

    return F.when(F.size(buckets) == 0, F.lit(0).cast("long")).otherwise(let(F.sort_array(buckets), lost))


def _scores(h: Column, buckets: int) -> Column:
    """``score, held_out`` of hashed words; needs the model's columns and ``is_trusted``. Both are NULL without words."""
    def both(b: Column) -> Column:
        total = let(F.col("weights"), lambda w: F.aggregate(b, F.lit(0).cast("long"), lambda t, x: t + F.get(w, x)))
        own = F.when(F.col("is_trusted"), _own_part(b)).otherwise(F.lit(0).cast("long"))
        size = F.nullif(F.size(b), F.lit(0))
        return let(
            total,
            lambda t: F.struct((t / SCORE_SCALE / size).alias("score"), ((t - own) / SCORE_SCALE / size).alias("held_out")),
        )

    return let(buckets_of(h, buckets), both)


def _with_model(rows: DataFrame, model: DataFrame) -> DataFrame:
    """Add the columns of the model's one row."""
    return rows.withColumns({name: model.select(name).scalar() for name in model.columns})


def best_cut(classes: list[tuple[int, int, int]]) -> float | None:
    """The score to cut at, from ``(class, trusted, rejected)`` counts of held-out scores; None without trusted ones.

    Of all cuts the one with the largest share of rejected documents below it, less ``TRUSTED_WEIGHT`` times
    that of trusted ones; of those alike, the one right below the next labelled document. If none is better
    than to drop nothing, the lowest class there is.
    """
    classes = sorted(classes)
    n_good, n_bad = (sum(c[k] for c in classes) for k in (1, 2))
    if not n_good:
        return None
    best, cut, good, bad = 0.0, classes[0][0], 0, 0
    for (_, g, b), (following, _, _) in zip(classes, classes[1:], strict=False):
        good, bad = good + g, bad + b
        value = bad / max(n_bad, 1) - TRUSTED_WEIGHT * good / n_good
        if value > best:
            best, cut = value, following
    return cut * CUT_CLASS


def held_out_cut(documents: DataFrame, model: DataFrame, buckets: int) -> float | None:
    """The cut between all trusted and all rejected documents (``text, is_trusted, is_rejected``) that are long enough.

    The driver sees counts of at most ``2 * CUT_CLASSES`` classes of scores.
    """
    # The labels are asked first, so that nothing but labelled texts is hashed, and once.
    chosen = _with_model(documents.where("is_trusted or is_rejected"), model)

    def place(h: Column) -> Column:
        at = F.floor(_scores(h, buckets)["held_out"] / CUT_CLASS)
        return F.when(
            F.size(h) >= MIN_WORDS, F.greatest(F.lit(-CUT_CLASSES), F.least(F.lit(CUT_CLASSES - 1), at)).cast("long")
        )

    placed = chosen.select("is_trusted", "is_rejected", let(hashed_words(F.col("text")), place).alias("at"))
    counts = placed.groupBy("at").agg(F.count_if("is_trusted"), F.count_if("is_rejected"))
    return best_cut([tuple(r) for r in counts.collect() if r["at"] is not None])


def judge_quality(
    df: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    min_score: float | None = None,
    buckets: int = BUCKETS,
) -> DataFrame:
    """Each row of ``df`` as the struct ``input`` with its counts, score and verdict.

    Columns: ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, score, held_out,
    base_failed, kept``. ``held_out`` is the score without the document's own part of the trusted counts, and
    equals ``score`` where it is not trusted; both are NULL for a document without words. A document is kept if it
    passes the base rules and ``held_out`` is at least ``min_score``; without that, the cut between held-out trusted
    and rejected documents. Where no trusted document is long enough there is none, and the base rules decide.

    NULL text counts as empty and fails the base rules. Repeated rows are judged alike and each
    counts in the raw corpus; a NULL id is never trusted. Without trusted documents the target is
    uniform over the buckets. An empty table gives no rows.
    """
    packed = _packed(df, labels, id_column=id_column)
    marks = written(label_marks(labels, id_column, packed), "marks")
    if marks.count() <= BROADCAST_MARKS:
        marks = F.broadcast(marks)
    prepared = df.select(
        F.struct("*").alias("input"), F.col(id_column).alias("doc"), whole_text(text).alias("text")
    )
    prepared = _with_labels(prepared, marks, packed)
    hashed = _with_labels(df.select(F.col(id_column).alias("doc"), hashed_words(whole_text(text)).alias("hashes")), marks, packed)
    # Written once: the cut and the verdicts both read the counts.
    model = written(ratio_weights(hashed, buckets), "weights")
    if min_score is None:
        min_score = held_out_cut(prepared.drop("input"), model, buckets)

    def measures(words: Column) -> Column:
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            # Joined, since translate looks up every character of the text.
            F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
            let(
                _hashes(words),
                lambda h: F.struct(repeated_words(h).alias("n_repeat_words"), _scores(h, buckets).alias("s")),
            ).alias("h"),
        )

    lines = F.filter(F.split("text", "\n", -1), lambda line: F.btrim(line, F.lit(WHITE)) != "")
    passed = F.lit(True) if min_score is None else F.coalesce(F.col("m.h.s.held_out") >= min_score, F.lit(False))
    measured = _with_model(prepared, model).select(
        "input",
        let(words_of(F.col("text")), measures).alias("m"),
        (F.size(F.split("text", SYMBOL, -1)) - 1).cast("long").alias("n_symbols"),
        let(lines, lambda l: F.size(l) - F.size(F.array_distinct(l))).cast("long").alias("n_dup_lines"),
    )
    failed = (F.col("m.n_words") < MIN_WORDS) | (
        F.col("m.h.n_repeat_words") * 100 > F.col("m.n_words") * MAX_REPEAT_PERCENT
    )
    return measured.select(
        "input",
        "m.n_words",
        "m.word_chars",
        "n_symbols",
        "n_dup_lines",
        "m.h.n_repeat_words",
        "m.h.s.score",
        "m.h.s.held_out",
        failed.alias("base_failed"),
        (~failed & passed).alias("kept"),
    )
