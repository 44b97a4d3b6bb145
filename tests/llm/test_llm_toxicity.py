import random
import zlib

import numpy as np
import pytest
from conftest import rows
from llm_corpus import TEXTS, no_documents, odd_documents

from orderlens.llm.toxicity import Features, Model, drop_toxic, fit, score, summaries, train, units, windows

INSULTS = ["blockhead", "nincompoop", "scoundrel", "dimwit"]


def corpus(n=600):
    random.seed(9)
    syllables = "ta ri no sel mun ka do fe lis par ven to ".split()
    word = lambda: "".join(random.choice(syllables) for _ in range(random.randrange(1, 4)))
    docs, labels = [], []
    for i in range(n):
        words = [word() for _ in range(random.randrange(5, 80))]
        toxic = i % 5 == 0
        for _ in range(random.randrange(1, 4) if toxic else 0):
            words.insert(random.randrange(len(words)), random.choice(INSULTS))
        docs.append((i, " ".join(words).capitalize() + "."))
        labels.append((i, int(toxic)))
    return docs, labels


@pytest.fixture(scope="module")
def tables(spark):
    docs, labels = corpus()
    return spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(labels, "doc_id bigint, toxic int")


@pytest.fixture(scope="module")
def model(tables):
    return train(*tables)


def test_held_out_accuracy(tables, model):
    docs, labels = tables
    found = rows(score(docs, model))
    truth = dict(rows(labels))
    assert all(h == (zlib.crc32(str(i).encode()) % 5 == 0) and p == (s >= 0.5) and 0 <= s <= 1 for i, h, s, p in found)
    held = [(p, truth[i]) for i, h, _, p in found if h]
    assert len(held) > 60
    assert np.mean([p == t for p, t in held]) >= 0.97


def test_gaps_and_inserted_characters(model):
    texts = ["talked to a scoundrel", "a s.c.o.u.n.d.r.e.l sel", "you s c o u n d r e l", "scoun-drel mun", "scouxndrel", "nincompooop"]
    assert (model.score(summaries(texts, model, {})) >= 0.5).all()
    assert (model.score(summaries(["tarino sel mun", "kado felis", "", "1 2 3"], model, {})) < 0.5).all()


def test_kernel():
    words = ["abcd", "abxcd", "zzzz", "abcd"]
    f = Features.of(words)
    k = f.kernel(f)
    assert np.allclose(np.diag(k), 1, atol=1e-5) and np.allclose(k, k.T, atol=1e-5)
    assert k[0, 3] == pytest.approx(1, abs=1e-5) and 0.05 < k[0, 1] < 1 and k[0, 2] == 0
    assert np.linalg.eigvalsh(k).min() > -1e-5


def test_units_and_windows():
    assert {"id10t", "i.d.i.o.t"} <= units("id10t I.D.I.O.T")
    assert "idiot" in units("an i d i o t here")
    long = "x" * 100
    assert all(len(w) <= 24 for w in windows(long)) and len(windows(long)) > 4
    assert windows("...") == []


def test_gaps_beyond_a_blank(model):
    spelled = [sep.join("scoundrel") for sep in ("  ", " - ", " . ", "- ", "\n")]
    cut = ["scoun drel", "block head", "nincom - poop", "dim, wit", "scoundr  el"]
    texts = [f"tarino sel {t} mun kado" for t in spelled + cut]
    assert (model.score(summaries(texts, model, {})) >= 0.5).all()
    clean = ["tarino sel mun ka do fe", "ri no - sel", "ta. ri. no.", "a b", "kado felis parven to sel lis"]
    assert (model.score(summaries(clean, model, {})) < 0.5).all()


def test_joined_neighbours():
    assert {"idiot"} <= units("i  d - i . o\nt") and {" idiot"} <= units("an idi - ot") & units("you id i ot are")
    assert units("one") == {"one"} and units("- .") == {"-", "."}


def test_insults_of_ordinary_words():
    """Neither word tells anything by itself, since clean texts have both."""
    random.seed(4)
    vocabulary = ["tarino", "selmun", "kadofe", "lispar", "vento", "munka", "felis", "doriven", "sack", "sad"]
    bags, toxic = [], []
    for i in range(400):
        words = random.choices(vocabulary, k=20)
        words = [w for w, after in zip(words, [*words[1:], ""], strict=True) if (w, after) != ("sad", "sack")]
        if i % 2:
            at = random.randrange(len(words))
            words[at:at] = ["sad", "sack"]
        bags.append(sorted(units(" ".join(words))))
        toxic.append(i % 2 == 1)
    model = fit(bags, np.array(toxic))
    scores = model.score(summaries(["felis munka sad sack vento", "felis sad munka sack vento"], model, {}))
    assert scores[0] > scores[1]


def test_long_texts_teach_with_all_their_words(spark):
    """The insult is one of more than 1,000 distinct words, the second in alphabetical order."""
    vocabulary = ["aa", *(f"{a}{b}{c}" for a in ("ta", "ri", "sel", "mun") for b in "bdfghklmnprstvwz" for c in range(20))]
    docs = [(i, " ".join([*vocabulary, *[INSULTS[i // 2 % 4]] * (i % 2)])) for i in range(120)]
    labels = [(i, i % 2) for i in range(120)]
    model = train(spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(labels, "doc_id bigint, toxic int"))
    assert (model.decisions(INSULTS) > 0).all() and (model.decisions(vocabulary) < 0).all()


def test_odd_documents(spark, model):
    found = rows(score(odd_documents(spark, 2), model))
    assert len(found) == 2 * len(TEXTS)
    assert {r[3] for r in found} == {0}
    docs = odd_documents(spark)
    assert sorted(rows(drop_toxic(docs, model)), key=repr) == sorted(rows(docs), key=repr)


def test_toxic_documents_go(tables, model):
    docs, _ = tables
    kept = {r[0] for r in rows(drop_toxic(docs, model))}
    assert kept == {r[0] for r in rows(score(docs, model)) if r[3] == 0}


def test_without_labels(spark, tables):
    docs, labels = tables
    nothing = labels.where("false")
    odd = spark.createDataFrame([(None, 1), (1, None), (99_999, 1), (2, 7)], "doc_id bigint, toxic int")
    for given in (nothing, odd, labels.where("toxic = 0")):
        assert {r[3] for r in rows(score(docs, train(docs, given)))} == {0}
    assert rows(score(no_documents(spark), fit([], np.empty(0, dtype=bool)))) == []
    assert isinstance(train(no_documents(spark), labels), Model)


def slow_kernel(a, b):
    """Normalised kernel of two words by listing all triples in order that span six letters at most."""

    def weights(word):
        word = f"\x02{word}\x03"
        found = {}
        for i in range(len(word)):
            for k in range(i + 2, min(i + 6, len(word))):
                for j in range(i + 1, k):
                    t = word[i] + word[j] + word[k]
                    found[t] = found.get(t, 0) + 0.7 ** (k - i + 1)
        return found

    x, y = weights(a), weights(b)
    dot = lambda p, q: sum(w * q.get(t, 0) for t, w in p.items())
    return dot(x, y) / (dot(x, x) * dot(y, y)) ** 0.5


def test_kernel_against_listing_triples():
    random.seed(3)
    words = ["".join(random.choices("abc1", k=random.randrange(1, 13))) for _ in range(40)] + ["scoundrel", "sc0undrel", "scxoundrel", "aaaaaaaa"]
    f = Features.of([w for word in words for w in windows(word)])
    assert np.allclose(f.kernel(f), [[slow_kernel(a, b) for b in words] for a in words], atol=1e-5)


def test_decisions_against_the_sum_over_landmarks():
    """Folding landmarks into one table, sums at the joint and least norms change no positive decision."""
    random.seed(8)
    word = lambda: "".join(random.choices("abcdeé-2", k=random.choice([1, 2, 3, 5, 9, 14, 22, 23, 40])))
    landmarks = [w for w in ("abcde", "edcba", "aabbcc", "2abc", "décab")]
    share = np.array([3.0, 2.5, -2.0, 4.0, 2.0])
    f = Features.of([w for name in landmarks for w in windows(name)])
    table = np.bincount(f.code, weights=f.weight * share[f.row], minlength=64**3)
    for bias in (-1.0, 0.3):
        model, texts = Model(table, bias, np.zeros(4)), [" ".join(word() for _ in range(random.randrange(30))) for _ in range(60)]
        exact = {}
        for u in set().union(*map(units, texts)):
            values = [sum(c * slow_kernel(w[1:-1], n) for c, n in zip(share, landmarks, strict=True)) + bias for w in windows(u) if w[1:-1].isalnum()]
            exact[u] = max(values, default=None)
        for text, seen in zip(texts, summaries(texts, model, {}), strict=True):
            positive = {u: v for u in units(text) if (v := model.decisions([u])[0]) > 0}
            for u, v in positive.items():
                if len(windows(u)) == 1 and windows(u)[0][0] == "\x02":
                    assert v == pytest.approx(exact[u], abs=1e-4)
            assert np.expm1(seen[1]) == pytest.approx(sum(positive.values()), rel=1e-4, abs=1e-4)
            if positive:
                assert seen[0] == pytest.approx(max(positive.values()), abs=1e-4)


def test_labels_given_twice_change_nothing(tables, model):
    docs, labels = tables
    again = train(docs, labels.unionByName(labels))
    assert np.array_equal(again.table, model.table) and again.bias == model.bias and np.allclose(again.curve, model.curve)


def test_bound_on_rows(tables, monkeypatch):
    """The bound in bytes leaves out whole texts."""
    from orderlens.llm import toxicity

    monkeypatch.setattr(toxicity, "SAMPLE_BYTES", 10_000)
    sample, _ = toxicity.sampled(*tables, "doc_id", "text", "toxic")
    taken = rows(sample)
    texts = {t for _, t in rows(tables[0])}
    for label in (0, 1):
        own = [t for _, toxic, t in taken if toxic == label]
        assert 0 < sum(len(t.encode()) for t in own) <= 10_000 and set(own) <= texts
