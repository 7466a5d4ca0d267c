"""The pipeline, stage by stage, against brute-force versions of its stages."""

import collections
import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from pagemill.llm import mixing, quality
from pagemill.session import table
from tests.llm.test_operators import VOCABULARY, components_by_hand, lines_by_hand, quality_by_hand, spark_hash

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def corpus(seed=11):
    """Documents in groups of near copies, with shared lines, junk, nulls and repeated rows; and labels."""
    rng = random.Random(seed)
    clean = [f"{a}{b}" for a in ("re", "to", "mi", "an", "st", "lo") for b in ("ver", "den", "ka", "sol", "ing", "ful", "mentation", "graphies")]
    junk = [f"{a}#{b}%" for a in "xyz" for b in "pqrst"]
    shared = " ".join(rng.choice(clean) for _ in range(12))
    texts, labels = [], []
    for group in range(24):
        source = junk if group % 6 == 5 else clean
        base = [rng.choice(source) for _ in range(rng.randint(60, 140))]
        for _ in range(rng.choice([1, 1, 3, 5])):
            words = list(base)
            for _ in range(rng.randint(0, 3)):
                words[rng.randrange(len(words))] = rng.choice(source)
            cut = rng.randint(1, len(words) - 1)
            lines = [" ".join(words[:cut]), " ".join(words[cut:])]
            texts.append("\n".join([*lines, shared] if group % 2 else lines))
            labels.append((len(texts) - 1, int(source is clean), 0))
    texts += ["short", "", None, "a b c " * 60, texts[0]]
    rows = [(n, t, rng.choice(["en", "de", None]), rng.choice(["web", "web", "books"]), len(t or "")) for n, t in enumerate(texts)]
    return [*rows, rows[2], rows[2]], rng.sample(labels, len(labels) // 2)


def quality_kept(rows, labels, buckets=quality.BUCKETS):
    """Base rules and the cut between held-out scores of trusted and rejected documents."""
    good = {d for d, q, t in labels if q == 1 and t == 0}
    bad = {d for d, q, _ in labels if q == 0}
    measures = quality_by_hand([r[:2] for r in rows], good, buckets)

    def score_without(doc):
        """The score by counts of trusted documents to which this one does not belong."""
        return quality_by_hand([r[:2] for r in rows], good - {doc}, buckets)[doc][5]

    ids = {r[0] for r in rows}
    classes = collections.Counter()
    scores = {}
    for doc in ids:
        scores[doc] = score_without(doc) if doc in good else measures[doc][5]
        if doc in good | bad and measures[doc][0] >= quality.MIN_WORDS:
            place = int(np.floor(scores[doc] / quality.CUT_CLASS))
            # Each row of a repeated document counts.
            times = 1
            classes[place, doc in good] += times
    cut = quality.best_cut([(p, classes[p, True], classes[p, False]) for p in {p for p, _ in classes}])
    kept = set()
    for doc in ids:
        n_words, *_, repeated, _ = measures[doc]
        if n_words >= quality.MIN_WORDS and 100 * repeated <= 50 * n_words and (cut is None or scores[doc] >= cut):
            kept.add(doc)
    return kept


def mixed(rows):
    """Raking in numpy over the cells, scaled to the budget, then sampling by the operator's hash."""
    coder = Tokenizer.from_file(VOCABULARY)
    cells, keys = collections.Counter(), []
    for doc, text, lang, source, _ in rows:
        words = [w.lower() for w in text.split()]
        long = [w for w in words if len(w.encode()) >= mixing.TOPIC_WORD_BYTES] or words
        keys.append((source or mixing.MISSING, lang or mixing.MISSING, topic_of(long)))
        cells[keys[-1]] += len(coder.encode(text, add_special_tokens=False).ids) + 1
    tokens = np.array(list(cells.values()), dtype=float)
    weight = tokens.copy()
    powers = [corpus_pipeline.MIX_POWERS[m] for m in ("source", "lang", "topic")]
    targets = []
    for axis, power in enumerate(powers):
        sums = collections.Counter()
        for k, t in cells.items():
            sums[k[axis]] += t
        raised = {k: t**power for k, t in sums.items()}
        targets.append({k: t / sum(raised.values()) for k, t in raised.items()})
    for _ in range(500):
        change = 0.0
        for axis, target in enumerate(targets):
            values = [k[axis] for k in cells]
            present = collections.Counter()
            for v, w in zip(values, weight, strict=True):
                present[v] += w
            factor = np.array([target[v] / present[v] for v in values])
            change = max(change, np.abs(factor - 1).max())
            weight = weight * factor
        if change <= mixing.TOLERANCE:
            break
    ratio, scale = weight / tokens, None
    while True:
        full = np.zeros(len(tokens), dtype=bool) if scale is None else ratio * scale >= 1
        rest = weight[~full].sum()
        following = (corpus_pipeline.MIX_BUDGET * tokens.sum() - tokens[full].sum()) / rest if rest else scale
        if scale is not None and following <= scale * (1 + 1e-9):
            break
        scale = following
    chance = dict(zip(cells, np.minimum(1.0, ratio * scale), strict=True))
    kept = []
    for (doc, text, *_), key in zip(rows, keys, strict=True):
        row = spark_hash(text, spark_hash(doc) & (2**64 - 1))
        place = ((spark_hash(row, spark_hash32(7) & (2**64 - 1)) & (2**64 - 1)) >> (64 - mixing.HASH_BITS)) / 2**mixing.HASH_BITS
        kept.append((place, chance[key]))
    return kept


def spark_hash32(value, seed=42):
    """Spark's hash of an INT."""
    mask, p1, p2, p3 = 2**64 - 1, 0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9
    rotate = lambda x, r: ((x << r) | (x >> (64 - r))) & mask
    h = (seed + 0x27D4EB2F165667C5 + 4) & mask
    h ^= (value & 0xFFFFFFFF) * p1 & mask
    h = (rotate(h, 23) * p2 + p3) & mask
    h ^= h >> 33
    h = h * p2 & mask
    h ^= h >> 29
    h = h * p3 & mask
    h ^= h >> 32
    return h - 2**64 if h >= 2**63 else h


def topic_of(words):
    from pagemill.llm.hashing import RangeHash

    counts = np.zeros(mixing.TOPICS, dtype=int)
    for w in words:
        data = np.frombuffer(w.encode(), dtype=np.uint8)
        counts[int(RangeHash(data).of(np.array([0]), np.array([len(data)]))[0] >> np.uint64(32)) % mixing.TOPICS] += 1
    return int(counts.argmax())


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    rows, labels = corpus()
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


def rows_of(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=str)


def test_pipeline_equals_brute_force(spark, folder):
    rows, labels = corpus()
    docs = table(spark, folder, "documents")
    stages = dict(corpus_pipeline.STAGES)

    kept = quality_kept(rows, labels)
    rows = [r for r in rows if r[0] in kept]
    docs = stages["quality rules"](spark, docs, folder).cache()
    assert rows_of(docs) == sorted(rows, key=str) and 20 < len(rows) < len(corpus()[0])

    cut = lines_by_hand([r[:2] for r in rows])
    rows = [(d, cut[d][2] if cut[d][1] else t, lang, s, len(cut[d][2]) if cut[d][1] else n) for d, t, lang, s, n in rows]
    docs = stages["line dedup"](spark, docs, folder).cache()
    assert rows_of(docs) == sorted(rows, key=str) and any(cut[d][1] for d in cut)

    groups = components_by_hand({r[0]: r[1] for r in rows}, corpus_pipeline.NEAR_WORDS, corpus_pipeline.NEAR_SIMILARITY)
    before, rows = len(rows), sorted({r for r in rows if groups[r[0]][1] == r[0]}, key=str)
    docs = stages["near dedup"](spark, docs, folder).cache()
    assert rows_of(docs) == rows and len(rows) < before

    chances = mixed(rows)
    sure = [r for r, (place, chance) in zip(rows, chances, strict=True) if place < chance * (1 - 1e-6)]
    docs = stages["source mixing"](spark, docs, folder).cache()
    assert all(abs(place - chance) > 1e-6 for place, chance in chances) and rows_of(docs) == sure and 0 < len(sure) < len(rows)

    coder = Tokenizer.from_file(VOCABULARY)
    packed = collections.defaultdict(list)
    for r in stages["best-fit packing"](spark, docs, folder).collect():
        packed[r["sequence_id"]].append(r)
    pieces = sorted((p["doc_id"], p["length"], p["ids_crc32"]) for parts in packed.values() for p in parts)
    want = []
    for doc, text, *_ in sure:
        ids = np.array([*coder.encode(text, add_special_tokens=False).ids, 0], dtype="<u4")
        want.append((doc, len(ids), zlib.crc32(ids.tobytes())))
    assert pieces == sorted(want)
    for parts in packed.values():
        parts.sort(key=lambda p: p["offset"])
        ends = np.cumsum([0, *[p["length"] for p in parts]])
        assert [p["offset"] for p in parts] == ends[:-1].tolist() and ends[-1] <= 2048
    assert sorted(map(tuple, corpus_pipeline.run(spark, folder).select("doc_id", "length", "ids_crc32").collect())) == pieces


def test_quality_is_computed_once_per_row(spark, folder):
    docs = table(spark, folder, "documents")
    judged = quality.judge_quality(docs, table(spark, folder, "labels"))
    alone = judged.select("input", "kept")._jdf.queryExecution().optimizedPlan().toString()
    stage = corpus_pipeline.quality(spark, docs, folder)._jdf.queryExecution().optimizedPlan().toString()
    assert 0 < stage.count("xxhash64") <= alone.count("xxhash64")
