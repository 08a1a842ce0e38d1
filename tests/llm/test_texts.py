"""Chat formatting, language-model scores, byte-pair encoding, toxicity and fingerprints."""

import collections
import hashlib
import math
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tests.compare import connect, differences
from tests.llm.conftest import LONG, ODD
from twosided.llm import bpe, chat_format, lm_score, spotsigs, toxicity
from twosided.llm.queries import ORACLE, QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_rows_as_sql(spark, name):
    assert differences(QUERIES[name](spark, SF_DIR), ORACLE[name], connect(SF_DIR)) == []


def chats(spark, rows):
    df = chat_format.format_chats(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, conv string"))
    read = df.select("conv", "formatted", chat_format.turns_of(F.col("formatted")).alias("turns"),
                     chat_format.loss_text(F.col("formatted"), F.col("loss_mask")).alias("loss"), F.aggregate(
                         "loss_mask", F.lit(0), lambda n, x: n + x["length"]).alias("covered"))
    return {row.conv: row for row in read.collect()}


def test_chats_are_read_back(spark):
    rng = random.Random(4)
    parts = ["</s>", "<s>", "[INST]", "[/INST]", "<sep>", "<role>", "</role>", "\\", "<", "[", "<\\s>", "[\\\\INST]", "/", "s>", "é😀", " ", "\n"]
    rows = [(conv, turn, rng.choice(["user", "assistant", "system", "a<sep>b", ""]), "".join(rng.choices(parts, k=rng.randint(0, 8))), "x")
            for conv in range(60) for turn in range(rng.randint(1, 9))]
    rows += [(99, turn, "user" if turn % 2 else "assistant", f"turn {turn}", "x") for turn in range(700)]
    found = chats(spark, rows)
    for conv in {row[0] for row in rows}:
        own = sorted(row[1:4] for row in rows if row[0] == conv)
        assert [tuple(x) for x in found[conv].turns] == [(role, text) for _, role, text in own]
        assert found[conv].loss == "".join(text for _, role, text in own if role == "assistant")
        assert found[conv].covered == len(found[conv].formatted)


def test_chats_of_odd_rows(spark):
    rows = [(None, 1, "user", "no conversation", "x"), (1, None, "user", "first", "x"), (1, 0, None, None, "x"), (1, 0, "user", "b", "x"),
            (1, 0, "user", "a", "x"), (1, 0, "user", "a", "x"), (2, 0, "assistant", None, "x"), (3, 0, "user", LONG, "x")]
    found = chats(spark, rows)
    assert [tuple(x) for x in found[1].turns] == [("user", "first"), ("", ""), ("user", "a"), ("user", "a"), ("user", "b")]
    assert found[1].formatted == "[INST]first[/INST]<role><sep></role>[INST]a<sep>a<sep>b[/INST]"
    assert (found[2].formatted, found[2].loss) == ("<s></s>", "")
    assert found[None].turns[0].text == "no conversation" and found[3].turns[0].text == LONG
    assert chats(spark, rows[:0]) == {}


def test_ids_are_those_of_the_library(spark, small):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    library.no_truncation()
    library.no_padding()
    with open(path, "rb") as file:
        own = bpe.Vocabulary(file.read())
    rng = random.Random(1)
    letters = ["a", "B", "Σ", "ς", "İ", "ß", "é", "\x1c", "\x85", "\xa0", "​", " ", "﻿", "<|endoftext|>", "<|startoftext|>",
               "<|", "'s", "'LL", "1", "²", "ǆ", "漢", "😀", "ͅ", "ﬁ", "\x00", "\n", "ẞ", "Ⅷ", "가", "ᄀ", "ᅡ"]
    texts = [x for x in small[1].values() if x] + ["".join(rng.choices(letters, k=rng.randint(0, 14))) for _ in range(1500)]
    texts += ["a" * 3000, "thin" * 500, "x" * 63 + "y", "é" * 200, LONG, "".join(rng.choices("theinganore", k=5000))]
    for text, wanted in zip(texts, library.encode_batch(texts, add_special_tokens=False), strict=True):
        ids = own.encode(text)
        assert np.frombuffer(ids, "<u4").tolist() == wanted.ids
        assert own.decode(ids) == library.decode(wanted.ids, skip_special_tokens=False)


def test_both_ways_of_merging_agree():
    with open(public_tokenizers.path("word_bpe_49k.json"), "rb") as file:
        own = bpe.Vocabulary(file.read())
    rng = random.Random(2)
    for _ in range(500):
        parts = [own.inner[ord(c)] for c in rng.choices("aeinrst", k=rng.randint(1, 60))]
        assert own._scan(list(parts)) == own._heap(list(parts))


def test_digests_of_odd_rows(spark, odd, none):
    path = public_tokenizers.path("word_bpe_49k.json")
    rows = bpe.digests(odd, "text", path).collect()
    assert len(rows) == len(ODD) and {row.digests for row in rows} == {"own"}
    coded = bpe.decode(bpe.encode(odd, "text", path), "ids", path).collect()
    by_text = {row.text: row for row in rows}
    for row in coded:
        assert by_text[row.text].ids_sha256 == hashlib.sha256(row.ids).hexdigest()
        assert by_text[row.text].decoded_sha256 == hashlib.sha256(row.decoded.encode()).hexdigest()
        assert by_text[row.text].n_tokens == len(row.ids) // 4
    assert by_text[None].n_tokens == 0 and bpe.digests(none, "text", path).count() == 0


def base_scores(texts):
    counts = collections.Counter()
    for key, text in texts:
        if zlib.crc32(str("" if key is None else key).encode()) % 5 != 1:
            counts.update(lm_score.words_of(text))
            counts[lm_score.END] += 1
    total, distinct = sum(counts.values()), len(counts)
    for key, text in texts:
        tokens = [*lm_score.words_of(text), lm_score.END]
        yield (key, len(tokens), sum(x in counts for x in tokens), total,
               round(sum(math.log10((counts[x] + 0.5) / (total + 0.5 * (distinct + 1))) for x in tokens), 6))


@pytest.mark.parametrize("head", [1 << 17, 50])
def test_scores_of_a_corpus(spark, small, monkeypatch, head):
    monkeypatch.setattr(lm_score, "HEAD", head)
    rows = lm_score.score(small[0], "doc_id", "text").collect()
    own = {(r.id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in rows}
    assert own == set(base_scores(list(small[1].items())))
    held = [r for r in rows if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held) > -math.inf


def test_scores_of_odd_rows(spark, odd, none):
    rows = lm_score.score(odd, "doc_id", "text").collect()
    own = sorted((str(r.id), r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in rows)
    for row, wanted in zip(own, sorted((str(a), *rest) for a, *rest in base_scores(ODD)), strict=True):
        assert row[:4] == wanted[:4] and row[4] == pytest.approx(wanted[4], abs=1e-5)
    assert all(math.isfinite(r.score) for r in rows) and lm_score.score(none, "doc_id", "text").count() == 0
    untrained = lm_score.score(odd.filter("doc_id = 4"), "doc_id", "text", held_out=int(zlib.crc32(b"4") % 5)).collect()
    assert {(r.n_known, r.train_tokens) for r in untrained} == {(0, 0)}


def test_probabilities_sum_to_one():
    words = [b"a%d" % (i % 400) for i in range(3000)]
    counts = collections.Counter(words)
    counts[lm_score.END] = 7
    head = [lm_score.END, *(x for x, _ in counts.most_common(350) if x)]
    known = lm_score.Frequencies(sum(counts.values()), len(counts), head, np.array([counts[x] for x in head]))
    model, seen = lm_score._train_texts(iter([b" ".join(words).decode()] * 3), known, 1)
    assert seen == 3 * 3001
    places, context = lm_score.Places(known), [b"a3", b"never", b"a5"]
    contexts = places.contexts(places.of(context))[-1:]
    outputs = [10 ** model.log10(contexts, np.array([i])) for i in range(known.outputs + 1)]
    assert sum(outputs) == pytest.approx(1, abs=1e-5)
    others = [counts[x] for x in counts if x not in head[: known.outputs]]
    assert sum(others) + 0.5 * (len(others) + 1) == pytest.approx(known.rest)


def test_products_of_tables_give_the_scores():
    words = [b"b%d" % (i * i % 300) for i in range(4000)]
    counts = collections.Counter(words)
    known = lm_score.Frequencies(4001, len(counts) + 1, [lm_score.END, *(x for x, _ in counts.most_common(200))], np.array([1, *(n for _, n in counts.most_common(200))]))
    model, _ = lm_score._train_texts(iter([b" ".join(words).decode()]), known, 2)
    places = lm_score.Places(known)
    own = places.of(words)
    contexts, wanted = places.contexts(own), np.minimum(own, known.outputs)
    for scale in (1, 30, 300):  # the larger ones are beyond what products of exponentials can hold
        wide = lm_score.Model(model.flat.astype(float), known.outputs)
        wide.vectors *= scale
        s = (wide.inputs[contexts] * wide.distance).sum(axis=1) @ wide.vectors.T + wide.bias
        top = s.max(axis=1)
        plain = (s[np.arange(len(own)), wanted] - top - np.log(np.exp(s - top[:, None]).sum(axis=1))).sum() / math.log(10)
        single = lm_score.Model(wide.flat.astype(np.float32), known.outputs).tables()
        assert single.log10(contexts, wanted) == pytest.approx(plain, rel=1e-5)
        assert scale == 30 or (single.powers is None) == (scale == 300)


def test_words_of_many_texts_are_those_of_each(monkeypatch):
    monkeypatch.setattr(lm_score, "PLACED", 20)
    texts = ["", None, "  two\tWORDS \n", " ", "\x0b\x0cÉa\x1c b\x85c\u00a0d", LONG, "a", *(x for _, x in ODD)]
    known = lm_score.Frequencies(9, 4, [lm_score.END, b"a", b"two", b"row"], np.array([4, 2, 2, 1]))
    places = lm_score.Places(known)
    found = list(places.each(texts))
    assert len(found) == len(texts)
    for (own, rare), text in zip(found, texts, strict=True):
        words = lm_score.words_of(text)
        assert own.tolist() == places.of(words).tolist() and len(own) == len(words) + 1
        assert rare == [x for x in words if x not in known.head]
        assert own.tolist() == [known.head.index(x) if x in known.head else 4 + lm_score.letters_of(x) for x in [*words, b""]]


def test_gradient_is_that_of_the_loss():
    known = lm_score.Frequencies(40, 4, [lm_score.END, b"a", b"b", b"c"], np.array([4, 20, 10, 6]))
    model, rng = lm_score.Model.start(known), np.random.default_rng(0)
    model = lm_score.Model(model.flat.astype(float), known.outputs)
    contexts, wanted, noise = rng.integers(0, 6, (9, lm_score.CONTEXT)), rng.integers(0, 5, 9), rng.integers(0, 5, 4)
    log_noise = np.log(4 * known.shares())

    def loss(flat):
        m = lm_score.Model(flat, known.outputs)
        r = (m.inputs[contexts] * m.distance).sum(axis=1)
        s = r @ m.vectors.T + m.bias - log_noise
        return np.log1p(np.exp(-s[np.arange(9), wanted])).sum() + np.log1p(np.exp(s[:, noise])).sum()

    slope = model.gradient(contexts, wanted, noise, log_noise)
    for i in [*rng.choice(np.flatnonzero(slope), 40), len(model.flat) - 1]:
        step = np.zeros_like(model.flat)
        step[i] = 1e-5
        assert slope[i] == pytest.approx((loss(model.flat + step) - loss(model.flat - step)) / 2e-5, abs=1e-3)


def test_toxic_held_out_texts_are_found(spark):
    rows = QUERIES["op5_toxicity"](spark, "/root/testdata/sf0.1").join(spark.read.parquet("/root/testdata/sf0.1/labels.parquet"), "doc_id").filter("held_out").collect()
    right = sum(r.predicted == r.toxic for r in rows) / len(rows)
    found = sum(r.predicted for r in rows if r.toxic) / sum(r.toxic for r in rows)
    assert right > 0.97 and found > 0.8


def test_pairs_of_terms_are_learned():
    rng, texts, labels, hasher = random.Random(3), [], [], toxicity.Hasher()
    for _ in range(3000):
        insult, group = rng.random() < 0.5, rng.random() < 0.5
        words = [f"filler{rng.randint(0, 40)}" for _ in range(8)] + ["insulting"] * insult + ["grouping"] * group
        texts.append(hasher.places(" ".join(words)))
        labels.append(int(insult and group))
    machine = toxicity.fit(texts, np.array(labels))
    right = [(machine.score(x) >= 0.5) == y for x, y in zip(texts, labels, strict=True)]
    assert sum(right) / len(right) > 0.99
    assert machine.score(hasher.places("insulting filler1")) < 0.5 < machine.score(hasher.places("insulting grouping filler1"))


def test_pairs_of_terms_near_the_base_rate_are_learned():
    rng, texts, labels, hasher = random.Random(4), [], [], toxicity.Hasher()
    for i in range(6000):  # 200 texts with one term, 2,000 with the other, 20 with both; these and 5 % of the rest are toxic
        insult, group = i < 200, i < 20 or 200 <= i < 2180
        words = [f"filler{chr(97 + rng.randint(0, 25))}{chr(97 + rng.randint(0, 25))}" for _ in range(8)] + ["insulting"] * insult + ["grouping"] * group
        texts.append(hasher.places(" ".join(words)))
        labels.append(int(i < 20 or not insult and rng.random() < 0.05))
    machine = toxicity.fit(texts, np.array(labels))
    assert machine.score(hasher.places("insulting grouping fillerab")) >= 0.5
    assert max(machine.score(hasher.places(x)) for x in ("insulting fillerab", "grouping fillerab", "fillerab")) < 0.5
    assert sum(machine.score(x) >= 0.5 for x in texts[:20]) >= 18 and sum(machine.score(x) >= 0.5 for x in texts[20:]) < 60


def test_toxicity_of_odd_rows(spark, odd, none):
    labels = spark.createDataFrame([(4, 1, 0), (4, 0, 1), (None, 1, 1), (5, 1, None), (8, 1, 0), (3, 0, 0)], "doc_id long, quality int, toxic int")
    machine = toxicity.train(odd, labels, "doc_id", "text", "toxic", held_out=-1)
    rows = toxicity.score(odd, "text", machine).collect()
    assert len(rows) == len(ODD) and all(0 <= r.score <= 1 for r in rows)
    assert toxicity.score(none, "text", machine).count() == 0
    untrained = toxicity.train(none, labels.limit(0), "doc_id", "text", "toxic")
    assert {r.score for r in toxicity.score(odd, "text", untrained).collect()} == {0.5}


def spots(text):
    found = collections.OrderedDict()
    import regex

    words = regex.sub(r"[^\p{L}\p{N}]+", " ", (text or "").lower()).strip().split(" ")
    content = [i for i, w in enumerate(words) if w not in spotsigs.COMMON]
    for i, word in enumerate(words):
        after = [words[j] for j in content if j > i][:2]
        if word in spotsigs.COMMON and len(after) == 2:
            found[(word, *after)] = True
    return set(found) or {" ".join(words)}


def alike(a, b):
    return len(a & b) / len(a | b)


def test_fingerprints_against_the_next_document(spark, small):
    rows = {r.doc_id: r for r in QUERIES["op6_spotsigs"](spark, SF_DIR).collect()}
    ids = sorted(small[1])
    for n, i in enumerate(ids):
        text, after = small[1][i] or "", small[1][ids[(n + 1) % len(ids)]] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        assert rows[i].n_chars == len(text) and rows[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert rows[i].near_edited == pytest.approx(alike(spots(text), spots(edited)))
        assert rows[i].near_next == pytest.approx(alike(spots(text), spots(after)))
        assert len(rows[i].fingerprint) == 8 * len(spots(text))


def test_fingerprints_of_odd_rows(spark, odd, none):
    rows = spotsigs.against_next(odd, "doc_id", "text").collect()
    assert len(rows) == len(ODD)
    assert len({r.fingerprint for r in rows if r.n_chars in (0, 4)}) == 1  # texts without words
    texts = [r.near_next for r in rows if r.id == 1]
    assert texts == [1.0]  # the next one, 2, has no words either
    assert spotsigs.against_next(none, "doc_id", "text").count() == 0


def test_near_pairs_are_those_of_all_pairs(spark, small):
    docs, texts = small
    pairs, members = spotsigs.near_pairs(docs, "doc_id", "text", 0.5)
    sets = {i: spots(x) for i, x in texts.items()}
    classes = {}
    for i in sorted(sets):
        classes.setdefault(frozenset(sets[i]), i)
    assert {(r.id, r["class"]) for r in members.collect()} == {(i, classes[frozenset(x)]) for i, x in sets.items()}
    firsts = sorted(classes.values())
    wanted = {(a, b) for n, a in enumerate(firsts) for b in firsts[n + 1 :] if alike(sets[a], sets[b]) >= 0.5}
    assert {(r.a, r.b) for r in pairs.collect()} == wanted and wanted
