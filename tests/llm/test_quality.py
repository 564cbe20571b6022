import numpy as np
import pytest

from thermolytics.llm import quality

from .cases import awkward, collected, frame
from ..conftest import SF

GOOD = "The report of the committee was read to the members, and it is on file with the board. " * 2


def test_gold_labels_are_met_without_being_used(spark):
    docs = spark.read.parquet(SF.replace("0.001", "0.01") + "/documents.parquet")
    gold = spark.read.parquet(SF.replace("0.001", "0.01") + "/labels.parquet").select("doc_id", "quality")
    got = quality.classify(docs).join(gold, "doc_id").toPandas()
    assert got[got.quality == 1].kept.mean() >= 0.99
    assert got[got.quality == 0].kept.mean() <= 0.15


def test_em_finds_accuracies_of_planted_labellers():
    """Votes drawn with known rates: EM gets back the class share and each labeller's hit rate."""
    rng = np.random.default_rng(1)
    k, n = len(quality.LABELLERS), 50_000
    bad = rng.random(n) < 0.1
    rate = np.linspace(0.3, 0.8, k)
    v = np.where(bad[:, None] & (rng.random((n, k)) < rate), 1, 0)
    patterns, counts = np.unique((v * 3 ** np.arange(k)).sum(axis=1), return_counts=True)
    posterior, table = quality.estimate(patterns, counts.astype(float))
    assert np.abs(table[:, 0, 1] - rate).max() < 0.05
    got = np.array([posterior[p] for p in (v * 3 ** np.arange(k)).sum(axis=1)])
    assert ((got < 0.5) == bad).mean() > 0.99


@pytest.mark.parametrize("text, labeller", [
    ("Of%%% athe*** erntwh.%%% Thntatwh&&& ndreea$$$ " * 4, "symbols"), ("ERWHED.!! EDHEEA!! ONLYND!! " * 8, "capitals"),
    ("thanon | thanonnd | aninged | ention. | Thntble | " * 5, "separators"), ("Same phrase once more again. " * 30, "repetition")])
def test_votes(text, labeller):
    n, s, _ = quality.statistics(text.encode())
    assert quality.votes(n, s)[quality.LABELLERS.index(labeller)] == 1


def test_awkward_rows(spark):
    docs = frame(spark, extra=True)
    got = quality.classify(docs).collect()
    assert len(got) == len(awkward())
    assert all(r["score"] == 0.0 and not r["kept"] for r in got if r["doc_id"] in (4, 5, 6))
    assert len({tuple(r) for r in got if r["doc_id"] == 11}) == 1
    kept = quality.keep_good(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] or -1 for r in kept.collect()) == sorted(r["doc_id"] or -1 for r in got if r["kept"])


def test_clean_only_and_empty_tables(spark):
    rows = [(i, f"{GOOD}Item {i} of the list.", "en", "s", 0) for i in range(30)]
    assert all(r["kept"] for r in quality.classify(frame(spark, rows)).collect())
    assert collected(quality.classify(frame(spark, []))) == []


def unlisted(n=40):
    """(lang, text): clean documents of languages without fixed function words."""
    import random
    parts = {
        "ru": ("и в не на что с по это как его к но они из у".split(), "дом река город книга слово время человек дорога ответ история".split(), " "),
        "pl": ("w na nie z do się że jest jak po za od ale co".split(), "książka miasto droga słowo człowiek odpowiedź rzeka historia żona".split(), " "),
        "fi": ("ja ei se että hän oli mutta niin kun kuin myös".split(), "talo kaupunki kirja sanoja ihminen vastaus historia järvi metsä".split(), " "),
        "zh": (list("的一是不了在人有我他这"), [chr(0x5000 + 7 * i) + chr(0x6000 + 5 * i) for i in range(200)], "")}
    for lang, (small, large, gap) in parts.items():
        for i in range(n):
            rng = random.Random(f"{lang}{i}")
            line = lambda: gap.join(rng.choice(small if rng.random() < 0.45 else large) for _ in range(12)) + "."
            yield lang, "\n".join(line() for _ in range(6))


def test_clean_documents_of_other_languages_are_kept(spark):
    import random
    junk = ["Of%%% ath{}*** erntwh.%%% Thnt{}&&& ndre{}$$$ ", "than{} | thanond{} | aninged{} | ention{}. | "]
    rows = [(i, f"{GOOD}Item {i} of the list.", "en", "s", 0) for i in range(300)]
    rows += [(1000 + i, " ".join(junk[i % 2].replace("{}", random.Random(i * 99 + j).choice("abcdefgh") * 3) for j in range(8)), "en", "s", 0) for i in range(60)]
    rows += [(2000 + i, text, lang, "s", 0) for i, (lang, text) in enumerate(unlisted())]
    got = {r["doc_id"]: r for r in quality.classify(frame(spark, rows)).collect()}
    assert all(r["kept"] and r["posterior"] > 0.9 for x, r in got.items() if not 1000 <= x < 2000)
    assert all(r["posterior"] < 0.1 for x, r in got.items() if 1000 <= x < 2000)


def test_word_length_counts_characters():
    n, s, _ = quality.statistics("достопримечательность обеспечение".encode())
    assert s["word_length"] == 16 and n == 2
    n, s, _ = quality.statistics(("这是一个很长的句子没有空格" * 3).encode())
    assert quality.votes(n, s)[quality.LABELLERS.index("word_length")] == 0


def gibberish(n, lang=lambda i: "en"):
    import random
    out = []
    for i in range(n):
        rng = random.Random(f"junk{i}")
        word = lambda: "".join(rng.choice("bcdfghjklmnpqrstvwxz") for _ in range(rng.randint(3, 9)))
        out.append((100_000 + i, " ".join(word() for _ in range(rng.randint(40, 200))), lang(i), "s", 0))
    return out


@pytest.fixture(scope="module")
def given_docs(spark):
    docs = spark.read.parquet(SF.replace("0.001", "0.01") + "/documents.parquet")
    return [tuple(r) for r in docs.select("doc_id", "text", "lang", "source", "n_chars").collect()]


def scores(df):
    return {r["doc_id"]: (r["score"], r["kept"]) for r in quality.classify(df).collect()}


def test_scores_do_not_depend_on_how_rows_lie(spark, given_docs):
    rows = given_docs + gibberish(100)
    base = frame(spark, rows)
    want = scores(base.repartition(8, "text"))
    for other in (base.coalesce(1), base.repartitionByRange(7, "doc_id").sortWithinPartitions("doc_id"),
                  base.orderBy("source", "lang").coalesce(3), base.repartition(16)):
        got = scores(other)
        assert got.keys() == want.keys() and all(abs(got[i][0] - want[i][0]) < 1e-6 and got[i][1] == want[i][1] for i in want)
    assert not any(kept for i, (_, kept) in want.items() if i >= 100_000)


@pytest.mark.parametrize("lang", [lambda i: f"x{i}", lambda i: None, lambda i: f"y{i % 3}"])
def test_rare_languages_do_not_hide_junk(spark, given_docs, lang):
    got = scores(frame(spark, given_docs + gibberish(60, lang)))
    assert not any(kept for i, (_, kept) in got.items() if i >= 100_000)


def test_against_a_plain_version(spark, given_docs):
    import xxhash
    rows = given_docs[:400]
    texts = {}
    for _, text, *_ in rows:
        texts.setdefault(text, 0)
        texts[text] += 1
    made = []
    for text, n in texts.items():
        words, s, found = quality.statistics(text.encode())
        if words:
            h = xxhash.xxh64_intdigest(b"", xxhash.xxh64_intdigest(text.encode(), 42))
            made.append((h - (h >> 63 << 64), quality.pattern(quality.votes(words, s)), *quality.features(words, s, found, {}), n))
    made.sort(key=lambda r: r[0])
    patterns, inverse = np.unique([r[1] for r in made], return_inverse=True)
    posterior, _ = quality.estimate(patterns, np.bincount(inverse, [r[4] for r in made]))
    w = quality.descend([r[2] for r in made], [r[3].astype(np.float32) for r in made], np.array([posterior[r[1]] for r in made]),
                        np.array([float(r[4]) for r in made]))
    got = scores(frame(spark, rows))
    for doc_id, text, *_ in rows:
        n, s, found = quality.statistics(text.encode())
        at, x = quality.features(n, s, found, {})
        assert abs(got[doc_id][0] - 1 / (1 + np.exp(-np.clip(w[quality.DIM] + (w[at] * x).sum(), -30, 30)))) < 1e-6


def test_sample_is_bounded_and_by_hash(spark, given_docs, monkeypatch):
    monkeypatch.setattr(quality, "SAMPLE", 300)
    rows = frame(spark, given_docs)
    a, b = scores(rows.repartition(5)), scores(rows.coalesce(1))
    assert all(abs(a[i][0] - b[i][0]) < 1e-6 for i in a)
