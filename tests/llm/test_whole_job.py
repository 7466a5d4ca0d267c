"""Cases where an operator once did less than its whole job."""

import re
import warnings

import pytest
from pyspark.sql import functions as F

from pagemill.llm import exact_dedup, pii, quality, url_rules
from pagemill.llm.licenses import scan_licenses
from pagemill.llm.line_dedup import drop_repeated_lines
from pagemill.llm.mixing import profile, rake
from pagemill.llm.pii import replace_entities
from pagemill.session import table
from tests.llm.conftest import LINE
from tests.llm.test_operators import spark_hash

# Quality rules


@pytest.mark.parametrize("folder", ["sf0.01", "sf0.1"])
def test_clean_text_without_a_label_passes_at_every_size(spark, folder):
    folder = f"/root/testdata/{folder}"
    labels = table(spark, folder, "labels")
    judged = quality.judge_quality(table(spark, folder, "documents"), labels).where("not base_failed")
    rows = judged.select("input.doc_id", "input.text", "n_words", "kept").join(labels, "doc_id", "left_anti").collect()
    # Symbols after the words, or between them, are the junk of these tables.
    marks = [len(re.findall(r"[#*$%&!]{2}|\|", r["text"])) / r["n_words"] for r in rows]
    clean = [r["kept"] for r, m in zip(rows, marks, strict=True) if m < 0.02]
    junk = [r["kept"] for r, m in zip(rows, marks, strict=True) if m >= 0.2]
    assert sum(clean) >= 0.98 * len(clean) and sum(junk) <= 0.15 * len(junk) and len(junk) > 20


def test_cut_parts_trusted_from_rejected():
    classes = [(-90, 0, 5), (-40, 0, 4), (-10, 1, 0), (3, 60, 1), (9, 39, 0)]
    assert quality.best_cut(classes) == -10 * quality.CUT_CLASS
    assert quality.best_cut([(2, 5, 0), (4, 5, 0)]) == 2 * quality.CUT_CLASS
    assert quality.best_cut([(2, 0, 3)]) is quality.best_cut([]) is None


def test_held_out_score_is_that_of_a_document_without_a_label(spark):
    texts = [f"alpha beta gamma delta {'alpha beta ' * n}word{n}" for n in range(6)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    trust = lambda ids: spark.createDataFrame([(n, 1, 0) for n in ids], "doc_id bigint, quality int, toxic int")
    score = lambda ids, column: {r[0]: r[1] for r in quality.judge_quality(df, trust(ids), buckets=64).select("input.doc_id", column).collect()}
    assert score([1, 2, 3], "held_out")[3] == pytest.approx(score([1, 2], "score")[3], abs=1e-5)
    assert score([1, 2, 3], "held_out")[5] == score([1, 2, 3], "score")[5]


def test_every_trusted_document_gives_counts(spark):
    # Where all are trusted, the target is the corpus itself and no bucket weighs anything.
    df = spark.range(25_000).select(F.col("id").alias("doc_id"), F.concat(F.lit("w"), F.col("id") % 5000).alias("text"))
    trust = df.select("doc_id", F.lit(1).alias("quality"), F.lit(0).alias("toxic"))
    for shift in (0, -9_000):
        moved, known = (x.withColumn("doc_id", F.col("doc_id") + shift) for x in (df, trust))
        scores = quality.judge_quality(moved, known, min_score=0.0).select("score").distinct().collect()
        assert [r[0] for r in scores] == [0.0]


def test_labels_of_neighbours_sparse_ids_and_texts_as_ids(spark):
    labels = [(n, n % 2, n % 3 == 0) for n in (-65, -64, -1, 0, 63, 64, 2**40 + 1, 2**62)]
    rows = spark.createDataFrame([(n, int(q), int(t)) for n, q, t in labels] + [(None, 1, 0)], "doc bigint, quality int, toxic int")
    want = {n: (q == 1 and not t, q == 0) for n, q, t in labels} | {1: (False, False), 62: (False, False), None: (False, False)}
    docs = spark.createDataFrame([(n,) for n in want], "doc bigint")
    for kind, packed in (("bigint", True), ("string", False)):
        left, right = (x.withColumn("doc", F.col("doc").cast(kind)) for x in (docs, rows))
        marked = quality._with_labels(left, quality.label_marks(right, "doc", packed), packed).collect()
        assert {r[0] and int(r[0]): (r["is_trusted"], r["is_rejected"]) for r in marked} == {k or k: v for k, v in want.items()}


def test_no_text_is_looked_up_by_character_and_no_value_written_as_a_decimal(spark, labels):
    texts = ["", "#", "#*a$%\n&|<>", " \x0b\x0c\r\t\n", "a\x0bb\u00a0c\x1cd", "😀 é#\n 中 文|", "# " * 3, None]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    judged = quality.judge_quality(df, labels, min_score=0.0)
    plan = judged._jdf.queryExecution().optimizedPlan().toString().lower()
    assert not re.findall(r"translate\(|round\(|pmod\(", plan)
    for r in judged.select("input.text", "word_chars", "n_symbols").collect():
        text = r["text"] or ""
        words = re.findall(r"[^\x20\x09-\x0D]", text)
        assert (r["word_chars"], r["n_symbols"]) == (len(words), len(re.findall(r"[#*$%&|<>]", text)))


@pytest.mark.parametrize("buckets", [64, 1000])
def test_bucket_is_the_remainder_of_the_hash(spark, buckets):
    df = spark.range(40).select(F.transform(F.sequence(F.lit(1), "id"), lambda n: F.xxhash64(n)).alias("h"))
    df = df.unionAll(spark.createDataFrame([([],)], "h array<bigint>"))
    for h, found in df.select("h", quality.buckets_of(F.col("h"), buckets).alias("b")).collect():
        pairs = [spark_hash(b, spark_hash(a) & (2**64 - 1)) for a, b in zip(h, h[1:], strict=False)]
        assert found == [x % buckets for x in h + pairs]


# Line dedup


def test_repeated_rows_that_lose_lines(spark):
    rows = [(n, f"{LINE}\n{LINE}\nown {n}\n{LINE}") for n in (0, 0, 0, 1, 2, 3, 4, None, None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = drop_repeated_lines(df).select("input.doc_id", "n_lines", "n_dropped", "kept").collect()
    assert len(found) == len(rows)
    for doc, lines, dropped, kept in found:
        assert (lines, dropped, kept) == ((4, 0, rows[6][1]) if doc == 4 else (4, 3, f"own {doc}"))


# Licences


def test_notices_without_a_licence_word(spark):
    df = spark.createDataFrame([(0, "Shared under CC BY-NC 4.0"), (1, "under nc 4.0")], "doc_id bigint, text string")
    found = {r[0]: tuple(r)[1:] for r in scan_licenses(df).select("input.doc_id", "labels", "score").collect()}
    assert found == {0: ("cc-by,cc-by-nc-4.0", 0.75), 1: ("", 0.0)}


# Mixing


def raked_shares(spark, tokens, wanted):
    cells = spark.createDataFrame([(*k, n) for k, n in tokens.items()], "source string, lang string, topic int, tokens bigint")
    kinds = {"source": "string", "lang": "string", "topic": "int"}
    targets = {m: spark.createDataFrame(list(t.items()), f"{m} {kinds[m]}, share double") for m, t in wanted.items()}
    raked = rake(cells, targets)
    return {m: {r[0]: r[1] for r in raked.groupBy(m).agg(F.sum("weight")).collect()} for m in wanted}


def test_related_margins_are_raked_to_the_targets(spark):
    tokens = {("a", "x", 0): 500, ("a", "y", 0): 1, ("b", "x", 0): 1, ("b", "y", 0): 500}
    wanted = {"source": {"a": 0.7, "b": 0.3}, "lang": {"x": 0.6, "y": 0.4}, "topic": {0: 1.0}}
    with warnings.catch_warnings():
        warnings.simplefilter("error", RuntimeWarning)
        shares = raked_shares(spark, tokens, wanted)
    for margin, target in wanted.items():
        assert shares[margin] == pytest.approx(target, rel=2e-3)


def test_targets_that_cannot_be_met_are_reported(spark):
    tokens = {("a", "x", 0): 50, ("b", "y", 0): 50}
    with pytest.warns(RuntimeWarning, match="not met"):
        raked_shares(spark, tokens, {"source": {"a": 0.7, "b": 0.3}, "lang": {"x": 0.4, "y": 0.6}, "topic": {0: 1.0}})


def test_topics_of_texts_without_long_words(spark):
    df = spark.createDataFrame([(n, f"w{n} " * 3, "s", "l") for n in range(40)], "doc_id bigint, text string, source string, lang string")
    assert profile(df).select("topic").distinct().count() > 1


# Surrogates


def test_people_of_one_family_keep_apart(spark):
    names = ["John", "Paul", "Carl", "Eric", "Ivan", "Noah", "Omar", "Theo", "Ralf", "Nils", "Jack", "Leon"]
    texts = [f"Mr {n} Smith." for n in names] + ["Mr Smith.", "Mr John Smith."]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = {r[0]: r[1] for r in replace_entities(df, key="k").select("input.doc_id", "text").collect()}
    assert len({found[n] for n in range(len(names))}) == len(names) and found[0] == found[len(names) + 1]
    assert len({t.split()[-1] for t in found.values()}) == 1 and len(found[len(names)].split()) == 2


def test_phones_with_separators_only(spark):
    df = spark.createDataFrame([(0, "call 212-555-0187 or 212.555.0187, not 123-45-6789 or 1.212.555.0187")], "doc_id bigint, text string")
    entities = replace_entities(df, key="k").select("entities").first()[0]
    assert [(e["kind"], e["mention"]) for e in entities if e["kind"] == "phone"] == [("phone", "212-555-0187"), ("phone", "212.555.0187")]
    digits = [re.sub(r"\D", "", e["surrogate"]) for e in entities if e["kind"] == "phone"]
    assert digits[0] == digits[1] != "2125550187"


def test_a_shape_that_runs_out_of_surrogates(spark):
    letters = "abcdefghijklmnopqrstuvwxyz"
    addresses = [f"{a}@{b}.de" for a in letters for b in letters][:400]
    df = spark.createDataFrame([(n, f"write to {a} now") for n, a in enumerate(addresses)], "doc_id bigint, text string")
    found = [r["entities"][0]["surrogate"] for r in replace_entities(df, key="k").select("entities").collect()]
    assert len(set(found)) == 400 and not set(found) & set(addresses)
    assert all(re.fullmatch(r"[a-z]+@[a-z]\.de", s) for s in found)


def test_numbers_of_a_used_up_shape_become_its_mask(spark, monkeypatch):
    monkeypatch.setattr(pii, "MAX_ATTEMPTS", 2)
    entities = spark.createDataFrame([("card", str(n)) for n in range(10)], "kind string, normal string")
    found = {r["normal"]: r["surrogate"] for r in pii.surrogate_table(entities, "k").collect()}
    assert found == dict.fromkeys(map(str, range(10)), "0")


# Exact dedup


def test_a_batch_that_ends_before_its_answers_can_be_run_again(spark, tmp_path, monkeypatch):
    index = exact_dedup.DigestIndex(spark, "digests_run_again", str(tmp_path / "index"), buckets=4)
    batch = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a")], "doc_id bigint, text string")
    answers = lambda name: {r["doc_id"]: (r["kept"], r["keep_id"]) for r in exact_dedup.dedup_batch(batch, index, batch=name).collect()}
    with monkeypatch.context() as patch:
        patch.setattr(exact_dedup, "lookup", lambda *_: (_ for _ in ()).throw(KeyboardInterrupt))
        with pytest.raises(KeyboardInterrupt):
            answers("first")
    assert index.entries().count() == 2
    want = {1: (False, 3), 2: (True, 2), 3: (True, 3)}
    assert answers("first") == want and answers("first") == want and index.entries().count() == 2
    assert answers("second") == {1: (False, 3), 2: (False, 2), 3: (False, 3)}
    spark.sql("drop table digests_run_again")


def test_a_table_on_its_own_leaves_no_table_behind(spark):
    before = {t.name for t in spark.catalog.listTables()}
    assert exact_dedup.dedup_exact(spark.createDataFrame([(1, "a")], "doc_id bigint, text string")).count() == 1
    assert {t.name for t in spark.catalog.listTables()} == before


# URL rules


def test_long_paths_of_one_host_and_columns_with_clashing_names(spark, monkeypatch):
    monkeypatch.setattr(url_rules, "ROWS_PER_RANGE", 50)
    monkeypatch.setattr(url_rules, "CUT_CHARS", 8)
    urls = [(n, f"http://www.example.com/en/{'x' * 3000}/{n % 7}/{'y' * (n % 50)}", n, "k", 1, "p") for n in range(1500)]
    urls += [(2000, None, 0, "k", 1, "p"), (2001, f"http://{'a.' * 500}net/es/", 0, "k", 1, "p"), (2001, "http://sub.example.com/de", 0, "k", 1, "p")]
    df = spark.createDataFrame(urls, "page_id bigint, url string, number int, key string, part int, payload string")
    rules = spark.createDataFrame([("example.com", "/en/", "block"), ("net", "/es/", "block"), ("com", "/", "allow"), ("", "/", "block")], url_rules.RULE_SCHEMA)
    found = [(r["page_id"], r["rule"], r["verdict"]) for r in url_rules.judge_urls(df, rules).collect()]
    want = [(n, "example.com/en/", "block") for n in range(1500)] + [(2000, None, "block"), (2001, "net/es/", "block"), (2001, "com/", "allow")]
    assert sorted(found, key=str) == sorted(want, key=str)
    assert len(url_rules._cuts(df.selectExpr("'k' key", "url path", "page_id number"))) > 5
