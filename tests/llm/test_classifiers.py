"""The three trained classifiers: held-out accuracy, odd texts, and folds."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from jobtide.llm import language_id, quality_classifier, queries, toxicity
from jobtide.llm.common import labelled_sample

ODD = [None, "", "  \n", "12 !!", "é", "word " * 40_000, "x" * 300_000]
LABELS = "doc_id long, quality int, toxic int"


@pytest.fixture(scope="module")
def words():
    rng = random.Random(1)
    parts = ["ka", "lo", "mi", "ten", "ra", "su", "ven", "dor"]
    return lambda: "".join(rng.choice(parts) for _ in range(rng.randint(1, 3)))


@pytest.fixture(scope="module")
def small():
    return "/root/testdata/sf0.01"


def test_quality(words):
    good = [" ".join(words() for _ in range(60)) + "." for _ in range(60)]
    junk = [" ".join(words() + "%%" for _ in range(60)) for _ in range(30)]
    junk += [" ".join([words()] * 60) for _ in range(30)]
    texts, labels = good[:40] + junk[:20] + junk[30:50], [1] * 40 + [0] * 40
    model = quality_classifier.train(pa.array(texts), labels)
    assert quality_classifier.score(pa.array(good[40:]), model).min() > 0.5
    assert quality_classifier.score(pa.array(junk[20:30] + junk[50:]), model).max() < 0.5
    odd = quality_classifier.score(pa.array(ODD), model)
    assert ((odd > 0) & (odd < 1)).all() and odd[0] == odd[1]
    for labels in ([], [1]):
        flat = quality_classifier.train(pa.array(good[: len(labels)], pa.string()), labels)
        assert len(set(quality_classifier.score(pa.array(good), flat))) == 1


def test_quality_scores_by_brute_force(words):
    """Buckets of every n-gram and word counted one by one, over Latin, Cyrillic and Chinese text."""
    from jobtide.llm import byte_text

    q = quality_classifier
    rng = np.random.default_rng(4)
    model = q.Model(rng.normal(size=q.BUCKETS).astype(np.float32), 0.3)

    def hashed(text):
        piece = next(byte_text.pieces(pa.array([text])))
        return int(byte_text.word_hashes(piece, np.array([0]), np.array([len(text.encode())]))[0])

    def score(text):
        total, n, seen = 0.0, 0, []
        for word in (text or "").replace("\n", " ").split(" "):
            if not word:
                continue
            for size in q.SIZES:
                for i in range(len(word) - size + 1):
                    total += model.scores[hashed(word[i : i + size]) >> 46]
                    n += 1
            total += model.scores[q.GRAMS + (hashed(word) >> 48)]
            n += 1
            if word in seen[-q.CLOSE_BY :]:
                total += model.scores[q.AGAIN if seen[-1] == word else q.NEAR]
                n += 1
            seen.append(word)
        return 1 / (1 + np.exp(-(total / (n + q.ZEROS) + model.bias)))

    texts = [None, "", " ", "a", "ab abc abc", "привет мир привет", "日本語の文章です。 日本語", "😀😀😀😀 é",
             *[" ".join(words() for _ in range(k)) for k in (3, 30)], "same same same other same\nsame"]
    assert np.allclose(q.score(pa.array(texts), model), [score(t) for t in texts], atol=1e-5)


def test_quality_reads_whole_texts_in_pieces(words):
    texts = pa.array([" ".join(words() for _ in range(600)) for _ in range(3)] + ["a"])
    model = quality_classifier.Model(np.random.default_rng(0).normal(size=quality_classifier.BUCKETS).astype(np.float32), 0.1)
    whole = quality_classifier.score(texts, model)
    from jobtide.llm import byte_text

    plain = byte_text.pieces.__defaults__
    byte_text.pieces.__defaults__ = (900, *plain[1:])
    try:
        assert np.allclose(quality_classifier.score(texts, model), whole, atol=0.02)
    finally:
        byte_text.pieces.__defaults__ = plain


def test_toxicity(words):
    insults = ["gribbel", "fnord", "zwackel"]
    rng = random.Random(3)
    plain = lambda: [words() for _ in range(40)]

    def toxic():
        text = plain()
        for _ in range(3):
            text[rng.randrange(40)] = rng.choice(insults)
        return " ".join(text)

    texts = [toxic() for _ in range(60)] + [" ".join(plain()) for _ in range(60)]
    model = toxicity.train(pa.array(texts), [1] * 60 + [0] * 60)
    assert {m[1:6] for m in model.landmarks} >= {i[:5] for i in insults}
    reader = toxicity.Reader(model)
    assert toxicity.score(pa.array([toxic() for _ in range(20)]), reader).min() > 0.7
    assert toxicity.score(pa.array([" ".join(plain()) for _ in range(20)]), reader).max() < 0.5
    tricks = ["f.n.o.r.d and g r i b b e l here zwackel", "gribxbel fnoxrd zwacxkel gribbxel"]
    assert toxicity.score(pa.array(tricks), reader).min() > 0.5
    odd = toxicity.score(pa.array(ODD), reader)
    assert (odd < 0.5).all() and len(odd) == len(ODD)
    flat = toxicity.train(pa.array([], pa.string()), [])
    assert len(set(toxicity.score(pa.array(texts), toxicity.Reader(flat)))) == 1


def test_toxicity_of_whole_documents_by_brute_force(words):
    """The score from its definition: kernel shares of all words, passage sums, worst passage, curve."""
    rng = random.Random(6)
    insults = ["gribbelei", "fnordig", "zwackeln", "zwackert", "gribxbelt"]
    text = lambda n, k: " ".join(rng.choice(insults) if rng.random() < k else words() for _ in range(n))
    texts = [text(60, 0.06) for _ in range(60)] + [text(60, 0) for _ in range(60)]
    model = toxicity.train(pa.array(texts), [1] * 60 + [0] * 60)
    asked = [text(n, k) for n in (0, 1, 5, 80, 300) for k in (0, 0.02, 0.2, 1)] + ["f n o r d i g here", "x" * 90]

    def value(token, mark):
        word = "".join(c for c in token if c.isalpha())
        if len(word) < toxicity.LETTERS:
            return 0.0
        word = toxicity.START + word
        step, size = toxicity.LONGEST - toxicity.OVERLAP, toxicity.LONGEST
        parts = [word] if len(word) <= size else [word[i : i + size] for i in range(0, len(word) - toxicity.OVERLAP, step)]
        best = max(float(toxicity.kernel(toxicity.coded([p]), mark)[0]) for p in parts)
        best /= float(toxicity.kernel(toxicity.coded([mark]), mark)[0])
        return min(best, 1.0) if best >= toxicity.RELATED else 0.0

    def score(text):
        tokens = toxicity.normal(text).split()
        rows = np.array([[value(t, m) for m in model.landmarks] for t in tokens]).reshape(len(tokens), len(model.landmarks))
        worst = model.bias
        sums = [np.minimum(rows[i : i + toxicity.PASSAGE].sum(0), toxicity.MOST) @ model.weights + model.bias
                for i in range(len(tokens)) if rows[i].any()]
        worst = max(sums) if sums else worst
        return 1 / (1 + np.exp(-(model.slope * worst + model.shift)))

    got = toxicity.score(pa.array(asked), toxicity.Reader(model))
    assert np.allclose(got, [score(t) for t in asked], atol=1e-4)


@pytest.mark.parametrize("module", [quality_classifier, toxicity])
def test_scores_of_odd_tables(table, words, module):
    texts = [" ".join(words() for _ in range(40)) + f" gribbel{i % 3} gribbel" * (i % 2) for i in range(60)]
    model = module.train(pa.array(texts), [i % 2 for i in range(60)])
    rows = [(1, texts[0], 5, 6), (1, texts[0], 5, 6), (None, None, None, None), (2, "", 5, 6)]
    ddl = "doc_id long, text string, score int, `a.b` int"
    found = module.with_score(table(rows, ddl), model)
    assert found.columns == ["doc_id", "text", "score", "a.b"]
    got = {}
    for r in found.collect():
        got.setdefault(r.doc_id, []).append(r.score)
    assert len(got[1]) == 2 and got[1][0] == got[1][1] and got[None] == got[2] and 0 < got[2][0] < 1
    assert module.with_score(table([], ddl), model).collect() == []


def test_kernel_is_the_definition():
    from itertools import combinations

    def brute(s, t, n=4, decay=0.6):
        found = {}
        for text, side in ((s, 0), (t, 1)):
            for at in combinations(range(len(text)), n):
                key = "".join(text[i] for i in at)
                found.setdefault(key, [0.0, 0.0])[side] += decay ** (at[-1] - at[0] + 1)
        return sum(a * b for a, b in found.values())

    strings = ["idiot", "idxiot", "toidi", "worthless", "abc"]
    for landmark in ("idiot", "wothles"):
        values = toxicity.kernel(toxicity.coded(strings), landmark)
        assert np.allclose(values, [brute(s, landmark) for s in strings], rtol=1e-4)


def test_related_compares_all_words_that_can_be_related():
    rng = random.Random(4)
    landmarks = ["blockhead", "scoundrel", "ignoramus", "fnord", "scum"]
    strings = ["blockhd", "lockhea", "coundre", "ignoram", "fnor", "scum", "mucs", "zzzz", "scccuumm"]
    for mark in landmarks:
        for _ in range(200):
            letters = [c for c in mark if rng.random() < 0.8]
            for _ in range(rng.randint(0, 3)):
                letters.insert(rng.randint(0, len(letters)), rng.choice("abcdeosu"))
            strings.append("".join(letters) + "x" * 4)
    codes = toxicity.coded(strings)
    found = toxicity.related(strings, landmarks)
    for k, mark in enumerate(landmarks):
        own = toxicity.kernel(toxicity.coded([mark]), mark)[0]
        values = toxicity.kernel(codes, mark)
        assert (toxicity.most_kernel(codes, mark) >= 0.9999 * values).all()
        share = values / own
        assert np.allclose(found[:, k], np.where(share < toxicity.RELATED, 0, np.minimum(share, 1)))
    assert found[0, 0] > 0.4 and found[1, 0] > 0.5 and found[2, 1] > 0.5 and found[3, 2] > 0.5


def test_language(docs_of, table, words):
    rng = random.Random(2)
    parts = {"aa": ["the", "ing", "ed", "wh"], "bb": ["que", "ñar", "ción", "os"], "cc": ["sch", "ung", "ein", "zu"]}
    text = lambda lang, k: " ".join("".join(rng.choice(parts[lang]) for _ in range(2)) for _ in range(k))
    rows = [(i, text(lang := list(parts)[i % 3], rng.randint(5, 80)), lang) for i in range(150)]
    rows += [(200, None, "aa"), (201, "??", "bb"), (None, "x", "cc"), (202, "lone", None)]
    docs = table(rows, "doc_id long, text string, lang string")
    content = language_id.dictionaries(docs, F.col("doc_id") < 100)
    assert sorted(content) == ["aa", "bb", "cc"]
    texts = [text(lang, 30) for lang in parts] + ODD
    found = [(r.lang_pred, r.score) for r in language_id.identify(docs_of(texts), content).orderBy("doc_id").collect()]
    assert [lang for lang, _ in found[:3]] == ["aa", "bb", "cc"]
    assert [lang for lang, _ in found[3:7]] == ["und"] * 4 and all(0 <= s <= 1 for _, s in found)
    none = language_id.identify(docs_of(texts), {}).select("lang_pred").distinct().collect()
    assert [r.lang_pred for r in none] == ["und"]
    assert language_id.identify(docs_of([]), content).collect() == []


def test_sample_is_bounded_and_keeps_the_fold(table, docs_of):
    texts = ["t"] * 50
    labels = table([(i, i % 2, 0) for i in range(60)] + [(3, None, 0), (None, 1, 0), (4, 1, 0)], LABELS)
    found, y = labelled_sample(docs_of(texts), labels, "quality", F.col("doc_id") < 40, 10)
    assert sorted(y) == [0] * 10 + [1] * 10 and len(found) == 20
    assert labelled_sample(docs_of([]), labels, "quality", F.lit(True), 10)[1] == []


@pytest.mark.parametrize("name, label, fold, least", [
    ("op5_quality_classifier", "quality", (5, 0), 0.95),
    ("op8_toxicity", "toxic", (3, 1), 0.8),
])
def test_held_out_labels(spark, small, name, label, fold, least):
    found = queries.QUERIES[name](spark, small).toPandas().set_index("doc_id")
    labels = pq.read_table(f"{small}/labels.parquet").to_pandas().set_index("doc_id")[label]
    held = [zlib.crc32(str(i).encode()) % fold[0] == fold[1] for i in found.index]
    assert found.held_out.tolist() == held and found.score.between(0, 1).all()
    own = found[found.held_out].join(labels, how="inner")
    yes, no = own.score[own[label] == 1].values, own.score[own[label] == 0].values
    assert ((yes[:, None] > no).mean() + 0.5 * (yes[:, None] == no).mean()) >= least


def test_held_out_languages(spark, small):
    found = queries.QUERIES["op6_language_id"](spark, small).toPandas().set_index("doc_id")
    lang = pq.read_table(f"{small}/documents.parquet", columns=["doc_id", "lang"]).to_pandas().set_index("doc_id").lang
    own = found[found.held_out].join(lang)
    assert (own.lang_pred == own.lang).mean() > 0.97


def test_one_document_language_leaves_the_others_their_dictionaries(spark, small, docs_of):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text", "lang")
    lone = "zuqo vexi pajo kwelu zuqo mirra vexi taloon kwelu bexo"
    more = spark.createDataFrame([(-1, lone, "zz")], "doc_id long, text string, lang string")
    fold = queries.remainder(4) != 2
    plain = language_id.dictionaries(docs, fold)
    with_lone = language_id.dictionaries(docs.unionByName(more), fold | (F.col("doc_id") == -1))
    assert {k: v for k, v in with_lone.items() if k != "zz"} == plain
    assert with_lone["zz"] == lone.encode()

    held = docs.where(~fold & F.col("text").isNotNull()).limit(400).toPandas()
    right = lambda known, cut: np.mean([
        known.identify(t[:cut])[0] == lang for t, lang in zip(held.text, held.lang)
    ])
    before, after = language_id.Identifier(plain), language_id.Identifier(with_lone)
    for cut in (60, None):
        assert right(after, cut) > right(before, cut) - 0.01
    assert after.identify("kwelu zuqo vexi mirra pajo bexo taloon kwelu")[0] == "zz"


def test_features_of_many_texts_need_no_more_memory_than_those_of_few():
    import tracemalloc

    rng = random.Random(1)
    words = ["".join(rng.choices("abcdefgh", k=6)) for _ in range(50)]
    texts = pa.array([" ".join(rng.choices(words, k=2_000)) for _ in range(400)])
    tracemalloc.start()
    try:
        found = quality_classifier.features(texts)
        now, peak = tracemalloc.get_traced_memory()
    finally:
        tracemalloc.stop()
    assert len(found) == 400 and peak - now < 80 << 20
    for at in (0, 31, 32, 399):
        alone = quality_classifier.features(texts.slice(at, 1))[0]
        assert all((a == b).all() for a, b in zip(found[at], alone, strict=True))
