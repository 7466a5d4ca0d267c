"""Every operator against a brute-force version, on plain, nasty and empty tables."""

import collections
import hashlib
import random
import re
import string
import zlib

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from pagemill.llm import components as components_module, exact_dedup, near_dedup, packing, quality, substring_dedup, tokens
from pagemill.llm.components import components
from pagemill.llm.licenses import PHRASES, scan_licenses
from pagemill.llm.line_dedup import drop_repeated_lines
from pagemill.llm.mixing import MARGINS, mix_sources, probabilities, rake
from pagemill.llm.near_dedup import near_duplicates
from pagemill.llm.pii import replace_entities, surrogate_table
from pagemill.llm.substring_dedup import remove_repeats
from pagemill.llm.tokens import CachedEncoder
from pagemill.llm.url_rules import RULE_SCHEMA, judge_urls
from pagemill.session import written
from tests.llm.conftest import LINE, LONG

WHITE = " \t\n\x0b\x0c\r"
LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
WORD = re.compile(r"[^\x20\x09-\x0D]+")
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def small(spark, texts, first=0):
    return spark.createDataFrame([(first + n, t) for n, t in enumerate(texts)], "doc_id bigint, text string")


def sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def mixed_texts(seed=3, n=60):
    """Texts that share lines, passages and near copies."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 6)))
    passage = " ".join(word() for _ in range(60))
    lines = [" ".join(word() for _ in range(12)) for _ in range(5)]
    base = [word() for _ in range(150)]
    texts = []
    for k in range(n):
        own = [" ".join(word() for _ in range(rng.randint(0, 40))) for _ in range(rng.randint(0, 4))]
        own += rng.sample(lines, rng.randint(0, 3))
        if k % 5 == 0:
            own.append(passage)
        if k % 3 == 0:
            copy = list(base)
            for _ in range(rng.randint(0, 9)):
                copy[rng.randrange(150)] = word()
            own = [" ".join(copy)]
        texts.append("\n".join(own))
    return [*texts, texts[0], texts[1], "", None, passage * 3]


# Line dedup


def lines_by_hand(rows, min_length=40, min_documents=5):
    holders = collections.defaultdict(set)
    for doc, text in rows:
        for line in (text or "").split("\n"):
            key = line.strip(WHITE).translate(LOWER)
            if len(key) >= min_length:
                holders[key].add(doc)
    answer = {}
    for doc, text in rows:
        lines = (text or "").split("\n")
        keys = [x.strip(WHITE).translate(LOWER) for x in lines]
        kept = [x for x, k in zip(lines, keys, strict=True) if len(holders[k]) < min_documents or max(holders[k]) == doc]
        answer[doc] = (len(lines), len(lines) - len(kept), "\n".join(kept))
    return answer


def test_lines_like_by_hand(spark):
    rows = list(enumerate(mixed_texts()))
    found = drop_repeated_lines(small(spark, [t for _, t in rows])).select("input.doc_id", "n_lines", "n_dropped", "kept")
    assert {r[0]: tuple(r)[1:] for r in found.collect()} == lines_by_hand(rows)


def test_lines_of_nasty_rows(edge, nothing):
    found = drop_repeated_lines(edge).select("input.*", F.col("n_lines").alias("found_lines"), "n_dropped", F.col("kept").alias("left"))
    rows = found.collect()
    assert len(rows) == edge.count() and drop_repeated_lines(nothing).count() == 0
    by = {r["doc_id"]: r for r in rows}
    assert by[107]["n_dropped"] == 0 and by[106]["n_dropped"] == 2 and by[8]["left"] == ""
    assert [r["left"] for r in rows if r["doc_id"] == 3] == [LONG, LONG]


# Best-fit packing


@pytest.mark.parametrize("entries", [200_000, 40])
def test_encoder_gives_the_ids_of_the_library(monkeypatch, entries):
    monkeypatch.setattr(tokens, "CACHE_ENTRIES", entries)
    coder = CachedEncoder(VOCABULARY)
    rng = random.Random(1)
    bits = ["a", "S", "s", "'s", "'re", "''", "'", "re", "ll", " ", "  ", "\n", "\t", "12", "!", "?!", "é", "ß", "\u3000", " ", "…", "中文", "½", "<|endoftext|>", "\r\n", "𝄞"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 25))) for _ in range(3000)]
    for first in range(0, len(texts), 300):
        part = texts[first : first + 300]
        ids, ends = coder.encode(part)
        for n, coded in enumerate(coder.tokenizer.encode_batch(part, add_special_tokens=False)):
            assert ids[ends[n] : ends[n + 1]].tolist() == [*coded.ids, 0], part[n]


def test_best_fit_fills_bins():
    rng = random.Random(5)
    sizes = [rng.randint(1, 100) for _ in range(2000)]
    bins = packing.best_fit(sizes, 100)
    assert sorted(x for b in bins for x in b) == list(range(2000))
    assert max(sum(sizes[x] for x in b) for b in bins) <= 100
    assert len(bins) <= -(-sum(sizes) // 100) * 1.01 + 1


def check_packing(df, placed, capacity):
    tokenizer = Tokenizer.from_file(VOCABULARY)
    tokenizer.encode_special_tokens = True
    texts = collections.Counter((r[0], r[1] or "") for r in df.select("doc_id", "text").collect())
    pieces = collections.Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in placed)
    wanted = collections.Counter()
    for (doc, text), times in texts.items():
        ids = np.array([*tokenizer.encode(text, add_special_tokens=False).ids, 0], dtype="<u4")
        cuts = [*packing.cut_points(len(ids), capacity), len(ids)]
        for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
            wanted[(doc, k, a, b - a, zlib.crc32(ids[a:b].tobytes()))] += times
    assert pieces == wanted
    sequences = collections.defaultdict(list)
    for r in placed:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in sequences.values():
        ends = 0
        for offset, length in sorted(parts):
            assert offset == ends
            ends += length
        assert ends <= capacity
    return len(sequences)


@pytest.mark.parametrize("items", [50_000, 20])
def test_packing_holds_every_piece_once(spark, edge, items):
    texts = small(spark, mixed_texts())
    for df in (texts, edge):
        pieces = packing.tokenize(df, VOCABULARY, "doc_id", "text", 256, with_ids=False)
        placed = packing.pack(pieces, 256, group_items=items).collect()
        used = check_packing(df, placed, 256)
        total = sum(r["length"] for r in placed)
        assert used <= -(-total // 256) * 1.1 + 2


def test_a_hundred_thousand_equal_rows_are_spread_over_groups(spark):
    for length, fitting in ((1500, 1), (700, 2), (10, 204)):
        pieces = written(spark.range(100_000).selectExpr(
            "cast(null as bigint) doc_id", "0 piece", "0L start", f"{length}L length", "7L ids_crc32"
        ), "pieces")
        groups = pieces.groupBy(F.pmod(F.monotonically_increasing_id(), F.lit(20)).alias("group")).count().collect()
        assert len(groups) == 20 and max(g["count"] for g in groups) < 6000
        placed = packing.pack(pieces, group_items=5000)
        found = placed.groupBy("sequence_id").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("offset").alias("places"), F.max(F.col("offset") + F.col("length")).alias("end")).collect()
        assert sum(r["n"] for r in found) == 100_000 and all(r["n"] == r["places"] and r["end"] == r["n"] * length for r in found)
        # Every group may keep an underfull bin that fits to no other.
        assert len(found) <= -(-100_000 // fitting) + 20


def test_underfull_bins_of_different_groups_are_merged(spark):
    # Pieces that fill a little over half a bin meet those that fill the rest in later rounds only.
    pieces = written(spark.range(40_000).selectExpr(
        "id doc_id", "0 piece", "0L start", "if(id < 20000, 1400L, 648L) length", "id ids_crc32"
    ), "pieces")
    placed = packing.pack(pieces, group_items=1000)
    assert placed.select("sequence_id").distinct().count() <= 20_000 * 1.01


def test_sequences_hold_the_ids(spark, nothing):
    df = small(spark, mixed_texts())
    placed = packing.pack_documents(df, VOCABULARY, capacity=128)
    made = packing.sequences(df, placed, VOCABULARY, capacity=128).collect()
    assert all(r["length"] == len(r["ids"]) <= 128 for r in made)
    assert packing.pack_documents(nothing, VOCABULARY).count() == 0


# Surrogates


PERSONAL = [
    "Write to Ann.Lee@mail.example.com or ANN.LEE@MAIL.EXAMPLE.COM, call +1 (212) 555-0187 or +1 212 555 0187.",
    "Host 10.20.30.40, again 10.20.30.40, card 4532 1234 5678 9012 and 4532123456789012.",
    'token = "9233A8ECF7C5B09FE5949719B6B82BC439E9329B" for Mrs Jane Doe, Mr. John Doe, Frau Müller.',
    "Господин Иванов и Госпожа Иванова, Κύριος Παπαδόπουλος; ssn 123-45-6789.",
]


def test_surrogates_are_consistent_and_alike(spark):
    found = replace_entities(small(spark, PERSONAL + PERSONAL), key="k").select("input.doc_id", "entities", "text")
    rows = {r[0]: r for r in found.collect()}
    assert [rows[n]["text"] for n in range(4)] == [rows[n + 4]["text"] for n in range(4)]
    mentions = [(e["kind"], e["mention"], e["surrogate"]) for n in range(4) for e in rows[n]["entities"]]
    for _, mention, surrogate in mentions:
        assert mention != surrogate and not any(mention in rows[n]["text"] for n in range(4))
    by = {m: s for _, m, s in mentions}
    assert by["Ann.Lee@mail.example.com"].lower() == by["ANN.LEE@MAIL.EXAMPLE.COM"].lower()
    assert by["ANN.LEE@MAIL.EXAMPLE.COM"].isupper()
    digits = lambda s: re.sub(r"\D", "", s)
    assert digits(by["+1 (212) 555-0187"]) == digits(by["+1 212 555 0187"])
    assert re.fullmatch(r"\d{4} \d{4} \d{4} \d{4}", by["4532 1234 5678 9012"])
    assert digits(by["4532 1234 5678 9012"]) == by["4532123456789012"]
    assert all(0 < int(x) < 256 for x in by["10.20.30.40"].split("."))
    assert by["Mrs Jane Doe"].startswith("Mrs ") and len(by["Mrs Jane Doe"].split()) == 3
    assert by["Госпожа Иванова"].endswith("ова") and by["Господин Иванов"].endswith("ов")
    assert by["Κύριος Παπαδόπουλος"].endswith("όπουλος")
    assert len({s.lower() for _, m, s in mentions}) >= len({m.lower() for _, m, _ in mentions}) - 1


def test_surrogates_never_meet(spark):
    entities = spark.createDataFrame([("ssn", f"{n:03d}") for n in range(150)], "kind string, normal string")
    rows = surrogate_table(entities, "key").collect()
    assert len({r["surrogate"] for r in rows}) == len(rows) == 150
    assert not {r["surrogate"] for r in rows} & {r["normal"] for r in rows}


def test_surrogates_of_nasty_rows(edge, nothing):
    rows = replace_entities(edge, "k").select("input.text", F.col("text").alias("new"), F.size("entities").alias("n_found")).collect()
    assert all(r["new"] == (r["text"] or "") and r["n_found"] == 0 for r in rows) and len(rows) == edge.count()
    assert replace_entities(nothing, "k").count() == 0


# Quality rules


def spark_hash(value, seed=42):
    if isinstance(value, str):
        number = xxhash.xxh64_intdigest(value.encode(), seed)
    else:
        number = xxhash.xxh64_intdigest((value & (2**64 - 1)).to_bytes(8, "little"), seed)
    return number - 2**64 if number >= 2**63 else number


def quality_by_hand(rows, good_ids, buckets):
    def features(words):
        h = [spark_hash(w) for w in words]
        pairs = [spark_hash(b, spark_hash(a) & (2**64 - 1)) for a, b in zip(h, h[1:], strict=False)]
        return [x % buckets for x in h + pairs]

    words = [(doc, WORD.findall(text or ""), text or "") for doc, text in rows]
    raw, good = np.ones(buckets), np.ones(buckets)
    for doc, w, _ in words:
        for b in features(w):
            raw[b] += 1
            good[b] += doc in good_ids
    answer = {}
    weights = [round(x * 2**20) for x in np.log(good / good.sum() * raw.sum() / raw)]
    for doc, w, text in words:
        windows = collections.defaultdict(list)
        for i in range(len(w) - 2):
            windows[tuple(w[i : i + 3])].append(i)
        places = {i + k for at in windows.values() if len(at) > 1 for i in at for k in range(3)}
        lines = [x for x in text.split("\n") if WORD.search(x)]
        f = features(w)
        score = sum(weights[b] for b in f) / 2**20 / len(f) if f else None
        answer[doc] = (len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(places), score)
    return answer


def test_quality_like_by_hand(spark, labels):
    texts = [*mixed_texts(), "a b c a b c a b c " * 30, "the same the same the same", "1 2 3 1 2 3 x # $ |\nx\nx\n \nx"]
    found = quality.judge_quality(small(spark, texts), labels, buckets=512)
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "score"]
    by_hand = quality_by_hand(list(enumerate(texts)), {3}, 512)
    for r in found.select("input.doc_id", *names, "base_failed", "kept").collect():
        assert tuple(r)[1:6] == by_hand[r["doc_id"]][:5], r
        assert r["score"] is by_hand[r["doc_id"]][5] is None or r["score"] == pytest.approx(by_hand[r["doc_id"]][5], abs=2e-6)
        assert r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"])


def test_quality_of_nasty_rows(edge, nothing, labels):
    rows = quality.judge_quality(edge, labels).select("input.text", "n_words", "base_failed", F.col("kept").alias("stays")).collect()
    assert len(rows) == edge.count() and all(r["base_failed"] and not r["stays"] for r in rows if not r["text"])
    assert {r["n_words"] for r in rows if r["text"] == LONG} == {60_000}
    assert quality.judge_quality(nothing, labels).count() == 0
    assert quality.judge_quality(edge, labels.limit(0)).count() == edge.count()


# URL rules


def test_urls_like_by_hand(spark):
    rng = random.Random(2)
    labels_ = ["com", "net", "a", "b", "www", "x"]
    hosts = [".".join(rng.choice(labels_) for _ in range(rng.randint(1, 4))) for _ in range(300)]
    urls = [f"http://{h}{rng.choice(['', '/', '/en/', '/en/x?q=/es/', '/es/#a', '?x'])}" for h in hosts]
    urls += [None, "", "nothing", "http://", "https://A.COM/En/", "x://y://z/en/", *(["http://a.com/en/1"] * 500)]
    rules = [("com", "/", "allow"), ("a.com", "/en/", "block"), ("net", "/es/", "block"), ("b.net", "", "allow"), ("a", "/en", "block"), ("a", "/en", "allow"), (None, "/", "block")]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string")
    found = {r["page_id"]: r for r in judge_urls(df, spark.createDataFrame(rules, RULE_SCHEMA)).collect()}
    assert len(found) == len(urls)
    for n, url in enumerate(urls):
        match = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)", url or "")
        host, path = (match[1].translate(LOWER), match[2]) if match else ("", "")
        fits = [r for r in rules if r[0] and f".{host}".endswith(f".{r[0]}") and path.startswith(r[1])]
        best = max(fits, key=lambda r: (len(r[0]), len(r[1]), r[2] == "block"), default=None)
        r = found[n]
        assert (r["host"], r["path"], r["rule"]) == (host, path, best and best[0] + best[1]), url
        assert r["verdict"] == (best[2] if best else "allow" if host else "block")
    assert judge_urls(df.limit(0), spark.createDataFrame(rules, RULE_SCHEMA)).count() == 0
    assert judge_urls(df, spark.createDataFrame([], RULE_SCHEMA)).where("rule is not null").count() == 0


# Near duplicates


def shingles_by_hand(text, size=3):
    words = WORD.findall((text or "").translate(LOWER))
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)} or ({tuple(words)} if words else set())


def components_by_hand(texts, size=3, similarity=85):
    sets = {n: shingles_by_hand(t, size) for n, t in texts.items()}
    parent = {n: n for n in texts}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= similarity * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {n: (len(sets[n]), root(n)) for n in texts}


@pytest.mark.parametrize(("block", "size", "similarity"), [(256, 3, 85), (4, 3, 85), (4, 5, 80)])
def test_near_duplicates_like_by_hand(spark, block, size, similarity, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK_DOCUMENTS", block)
    texts = [*mixed_texts(n=90), "A b", "a B", "a", "one two three", "one two three four"]
    found = near_duplicates(small(spark, texts), size=size, similarity=similarity).collect()
    assert {r[0]: (r[1], r[2]) for r in found} == components_by_hand(dict(enumerate(texts)), size, similarity)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in found)


def test_links_beside_the_center_of_a_group_are_found(spark):
    # Each text changes one more part of the one before, so that far ones are linked through others only.
    rng = random.Random(9)
    base = [f"w{rng.randrange(10**6)}" for _ in range(400)]
    texts = []
    for n in range(40):
        texts.append(" ".join(base))
        base[9 * n % 400 : 9 * n % 400 + 9] = [f"n{rng.randrange(10**6)}" for _ in range(9)]
    random.Random(1).shuffle(texts)
    found = near_duplicates(small(spark, texts)).collect()
    assert {r[0]: (r[1], r[2]) for r in found} == components_by_hand(dict(enumerate(texts)))


def test_a_large_group_of_near_copies_makes_few_pairs(spark):
    rng = random.Random(2)
    base = [f"w{n}" for n in range(200)]
    texts = []
    for n in range(600):
        copy = list(base)
        copy[rng.randrange(200)] = f"own{n}"
        texts.append(" ".join(copy))
    documents = small(spark, texts)
    sketch = documents.mapInArrow(near_dedup._sketch(3), "doc_id long, n_shingles long, digest_a long, digest_b long, posted array<long>")
    classes = sketch.groupBy(*near_dedup.KEYS).agg(F.min("doc_id").alias("rep"), F.first("posted").alias("posted")).cache()
    posted = near_dedup.prefix_postings(classes, near_dedup.least_matches(85)).cache()
    pairs = near_dedup.center_pairs(posted)
    assert pairs.count() < 600
    sets = near_dedup.sets_of(documents, classes, classes, 3).cache()
    links = near_dedup.confirmed(pairs, sets, 85).cache()
    members = near_dedup.open_clusters(posted, near_dedup.center_labels(links)).cache()
    # A class is copied to a cell or two, not to one per block of the group.
    assert near_dedup.cells_of(members, classes, sets).count() < 1500
    assert near_duplicates(documents).select("component_id").distinct().count() == 1


def test_near_duplicates_of_nasty_rows(edge, nothing):
    rows = near_duplicates(edge).collect()
    assert len(rows) == edge.count() and near_duplicates(nothing).count() == 0
    assert {r["component_id"] for r in rows if r["doc_id"] == 4} == {3}
    assert all(r["component_id"] is None and r["kept"] for r in rows if r["doc_id"] is None)
    assert all(r["component_id"] == r["doc_id"] for r in rows if r["n_shingles"] == 0)


@pytest.mark.parametrize("task_links", [1 << 18, 100])
def test_components_of_long_chains(spark, monkeypatch, task_links):
    monkeypatch.setattr(components_module, "TASK_LINKS", task_links)
    links = [(n, n + 1) for n in range(200)] + [(1000, 1001), (1001, 1002), (5, 5)] + [(2000, 2000 + n) for n in range(300)]
    random.Random(4).shuffle(links)
    found = components(spark.createDataFrame(links, "a bigint, b bigint"), "a", "b")
    named = {r[0]: r[1] for r in found.collect()}
    assert named == {**{n: 0 for n in range(201)}, **{n: 1000 for n in range(1000, 1003)}, **{2000 + n: 2000 for n in range(300)}}


# Mixing


def test_raking_like_numpy(spark):
    rng = np.random.default_rng(0)
    table = rng.integers(1, 100, (3, 4, 2)).astype(float)
    rows = [(f"s{i}", f"l{j}", k, int(table[i, j, k])) for i in range(3) for j in range(4) for k in range(2)]
    cells = spark.createDataFrame(rows, "source string, lang string, topic int, tokens bigint")
    shares = [np.array([0.2, 0.3, 0.5]), np.array([0.1, 0.2, 0.3, 0.4]), np.array([0.5, 0.5])]
    names = [[f"s{i}" for i in range(3)], [f"l{j}" for j in range(4)], [0, 1]]
    kinds = ["string", "string", "int"]
    targets = {
        m: spark.createDataFrame([(a, float(b)) for a, b in zip(names[n], shares[n], strict=True)], f"{m} {kinds[n]}, share double")
        for n, m in enumerate(MARGINS)
    }
    raked = rake(cells, targets, rounds=40, tolerance=1e-9)
    for _ in range(60):
        for axis, share in enumerate(shares):
            others = tuple(a for a in range(3) if a != axis)
            shape = [1, 1, 1]
            shape[axis] = -1
            table = table * (share / table.sum(axis=others)).reshape(shape)
    for r in raked.collect():
        assert r["weight"] == pytest.approx(table[int(r["source"][1]), int(r["lang"][1]), r["topic"]], rel=1e-6)
    chosen = probabilities(raked, 0.6).collect()
    assert all(0 < r["probability"] <= 1 for r in chosen)
    assert sum(r["probability"] * r["tokens"] for r in chosen) == pytest.approx(0.6 * sum(r["tokens"] for r in chosen), rel=1e-6)


def test_sampling_follows_the_probability(spark):
    rows = [(n, "a b c d", "en" if n % 4 else "fr", "s") for n in range(8000)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    found = mix_sources(df, budget=0.5, powers={"source": 1, "lang": 0.0, "topic": 1})
    for r in found.groupBy("lang").agg(F.avg("probability").alias("p"), F.avg(F.col("kept").cast("int")).alias("share")).collect():
        assert r["share"] == pytest.approx(r["p"], abs=0.03)
    shares = found.where("kept").groupBy("lang").count().collect()
    assert shares[0]["count"] == pytest.approx(shares[1]["count"], rel=0.1)


def test_mixing_of_nasty_rows(edge, nothing):
    rows = mix_sources(edge).collect()
    assert len(rows) == edge.count() and all(0 <= r["probability"] <= 1 for r in rows)
    assert mix_sources(nothing).count() == 0


# Repeated strings


def repeats_by_hand(rows, length=100):
    seen, answer = set(), {}
    for doc, text in sorted(rows):
        data = (text or "").encode()
        covered = np.zeros(len(data), dtype=bool)
        for start in range(len(data) - length + 1):
            if data[start : start + length] in seen:
                covered[start : start + length] = True
            seen.add(data[start : start + length])
        kept = bytes(b for b, c in zip(data, covered, strict=True) if not c)
        answer[doc] = (len(data), int(covered.sum()), kept)
    return answer


def test_suffix_array_is_sorted():
    rng = np.random.default_rng(0)
    for _ in range(10):
        data = rng.integers(97, 99, 400).astype(np.uint8)
        data[200:] = data[:200]
        text = bytes(data)
        order = substring_dedup.suffix_array(data, 100).tolist()
        assert order == sorted(range(400), key=lambda i: (text[i : i + 100], i))
        ends = np.full(400, 400)
        prefix = substring_dedup.common_prefixes(substring_dedup._words(data), np.array(order), ends)
        for (a, b), n in zip(zip(order, order[1:], strict=False), prefix[1:], strict=False):
            same = 0
            while max(a, b) + same < 400 and text[a + same] == text[b + same]:
                same += 1
            assert same == n


def test_merging_shards_marks_all_but_the_first():
    rng = np.random.default_rng(1)
    shards, every = [], collections.defaultdict(list)
    places = iter(rng.permutation(1000))
    for number in range(5):
        strings = np.unique(rng.integers(0, 60, 40).astype("S3"))
        at = np.array([next(places) for _ in strings])
        shards.append((strings, at.copy()))
        for k, s in enumerate(strings):
            every[s].append((at[k], number, k))
    late = substring_dedup.merge_firsts([(s, a.copy()) for s, a in shards])
    for holders in every.values():
        first = min(holders)
        assert all(late[n][k] == ((at, n, k) != first) for at, n, k in holders)


@pytest.mark.parametrize("contexts", [10_000, 2])
def test_repeats_like_by_hand(spark, contexts, monkeypatch):
    monkeypatch.setattr(substring_dedup, "SHARD_CONTEXTS", contexts)
    texts = [*mixed_texts(), "ab" * 400, "z" * 350, "é" * 200, "q" * 99]
    rows = list(enumerate(texts))
    found = remove_repeats(small(spark, texts)).collect()
    by_hand = repeats_by_hand(rows)
    assert {r["doc_id"]: (r["n_bytes"], r["n_removed"], bytes(r["kept"])) for r in found} == by_hand
    for r in found:
        assert all(a["end"] < b["first"] for a, b in zip(r["spans"], r["spans"][1:], strict=False))


def test_repeats_of_nasty_rows(edge, nothing):
    rows = remove_repeats(edge).collect()
    assert len(rows) == edge.count() and remove_repeats(nothing).count() == 0
    long = {r["doc_id"]: r["n_removed"] for r in rows if r["n_bytes"] == len(LONG)}
    assert long[4] == len(LONG) and long[3] < len(LONG)


# Licences


def test_licenses_like_by_hand(spark):
    pieces = ["MIT License", "licensed under CC BY-NC 4.0.", "the Apache  License, Version 2.0", "GNU General\nPublic License", "permit licenses", "café cc", "by mit", "license"]
    rng = random.Random(6)
    texts = [" ".join(rng.choice(pieces) for _ in range(rng.randint(0, 6))) for _ in range(80)]
    for r in scan_licenses(small(spark, texts)).select("input.doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score").collect():
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", texts[r["doc_id"]].translate(LOWER))
        places = [(i, label) for p, label in PHRASES.items() for i in range(len(words)) if words[i : i + len(p.split())] == p.split()]
        at = [i for i, _ in places]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"]) == (len(words), len(at), min(at, default=None), max(at, default=None))
        assert r["base_labels"] == ",".join(sorted({x for _, x in places}))
        assert set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(",")) and 0 <= r["score"] <= 1


def test_license_templates_are_found_in_context(spark):
    texts = ["x y Released under the MIT License. z", "Licensed under the Apache License, Version 2.0", "under the license of apache released mit", "plain text"]
    rows = {r[0]: r for r in scan_licenses(small(spark, texts)).select("input.doc_id", "labels", "score").collect()}
    assert rows[0]["labels"] == "mit,mit-notice" and rows[0]["score"] == 1
    assert rows[1]["labels"] == "apache,apache-2.0"
    assert rows[2]["labels"] == rows[3]["labels"] == "" and rows[3]["score"] == 0


def test_licenses_of_nasty_rows(edge, nothing):
    rows = scan_licenses(edge).select("input.text", "n_words", "labels").collect()
    assert len(rows) == edge.count() and scan_licenses(nothing).count() == 0
    assert all(r["n_words"] == 0 and r["labels"] == "" for r in rows if not r["text"])


# Exact duplicates


def test_exact_copies_like_by_hand(spark):
    texts = mixed_texts()
    found = exact_dedup.dedup_exact(small(spark, texts)).collect()
    groups = collections.defaultdict(list)
    for n, t in enumerate(texts):
        groups[t or ""].append(n)
    for r in found:
        same = groups[texts[r["doc_id"]] or ""]
        assert tuple(r) == (r["doc_id"], max(same), len(same), r["doc_id"] == max(same), sha(texts[r["doc_id"]] or ""))


def test_index_remembers_earlier_batches(spark, tmp_path):
    index = exact_dedup.DigestIndex(spark, "digests_of_batches", str(tmp_path / "index"), buckets=4)
    first = exact_dedup.dedup_batch(small(spark, ["a", "b", "a"]), index).collect()
    assert {r["doc_id"]: r["kept"] for r in first} == {0: False, 1: True, 2: True}
    again = exact_dedup.DigestIndex(spark, "digests_of_batches")
    second = exact_dedup.dedup_batch(small(spark, ["b", "c", "c"], first=10), again).collect()
    assert {r["doc_id"]: (r["kept"], r["keep_id"]) for r in second} == {10: (False, 1), 11: (False, 12), 12: (True, 12)}
    assert again.entries().count() == 3
    spark.sql("drop table digests_of_batches")


def test_exact_copies_of_nasty_rows(edge, nothing):
    rows = exact_dedup.dedup_exact(edge).collect()
    assert len(rows) == edge.count() and exact_dedup.dedup_exact(nothing).count() == 0
    assert {r["kept"] for r in rows if r["doc_id"] == 4} == {True} and {r["kept"] for r in rows if r["doc_id"] == 3} == {False}


def test_line_constant():
    assert len(LINE) >= 40
