import base64
import random
import re

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer, models

from footfall.llm import bpe, langid, pii, token_counts

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def known():
    ranks = {
        base64.b64decode(a): int(b)
        for a, b in map(bytes.split, open(RANKS, "rb"))  # noqa: SIM115
    }
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=40))
def test_bpe_is_that_of_the_rank_file(known, text):
    (ids,) = bpe.load(RANKS).encode([text])
    assert ids.tolist() == known.encode_ordinary(text)
    assert bpe.load(RANKS).decode(ids) == text.encode()


def test_bpe_cuts_change_nothing(known, monkeypatch):
    monkeypatch.setattr(bpe, "SLICE_CHARS", 7)
    draw = random.Random(3)
    texts = ["".join(draw.choice("ab1é \n\t.'s") for _ in range(200)) for _ in range(200)]
    texts += ["", "x" * 50, " " * 50, "a\x1f b   c" * 9]
    for text, ids in zip(texts, bpe.load(RANKS).encode(texts), strict=True):
        assert ids.tolist() == known.encode_ordinary(text)


def test_bpe_offsets_of_split_characters():
    coder = bpe.load(RANKS)
    text = "aé\U0001f9ff z"
    (ids,) = coder.encode([text])
    starts = coder.offsets(ids)
    assert len(starts) == len(ids) and starts[0] == 0 and starts[-1] == text.rindex(" ")
    assert list(starts).count(2) > 1  # the emoji takes several ids
    assert coder.offsets(np.empty(0, np.int32)).tolist() == []


def test_bpe_rows(docs, empty, known):
    found = bpe.encode(docs, RANKS, offsets=True, packed=True, decoded=True)
    found = bpe.decode(found.withColumnRenamed("decoded", "at_once"), RANKS)
    rows = found.withColumn("again", F.col("decoded").cast("string")).collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert r.ids == known.encode_ordinary(r.text or "") and r.again == (r.text or "")
        assert r.packed == b"".join(i.to_bytes(4, "little") for i in r.ids)
        assert len(r.starts) == len(r.ids) and r.row == "own" and r.at_once == r.decoded
    assert bpe.decode(bpe.encode(empty, RANKS), RANKS).count() == 0


PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_spans(text):
    found = []
    for order, (kind, pattern) in enumerate(PLAIN.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            fine = {
                "email": lambda m, d: True,
                "ip": lambda m, d: all(int(p) <= 255 for p in m[0].split(".")),
                "card": lambda m, d: 12 <= len(d) <= 19 and pii.luhn(d),
                "phone": lambda m, d: 9 <= len(d) <= 15,
            }[kind]
            if fine(m, digits):
                found.append((m.start(), order, f"{kind}:{m.start()}:{m.end()}"))
    return [x[2] for x in sorted(found)]


@settings(max_examples=2000, deadline=None)
@given(
    st.lists(
        st.sampled_from(
            ["a@b.c", "@", ".", "1.2.3.4", "256", "4111111111111111", "+49 30", "1", "-", " ", "_x", "(", "é", "٣"]
        ),
        max_size=14,
    )
)
def test_pii_base_spans(parts):
    text = "".join(parts)
    base = [s for s in pii.find_spans(text) if s.kind in pii.BASE_KINDS]
    assert [f"{s.kind}:{s.start}:{s.end}" for s in base] == plain_spans(text)


def test_pii_is_linear():
    for bad in ("a" * 10**5, "1" * 10**5, "1." * 50000, "1 " * 50000, "+1" * 50000, "a@" * 50000):
        pii.find_spans(bad)


def test_pii_checks_and_context():
    text = "iban DE89370400440532013000, DE89370400440532013001; ssn 123-45-6789 or 123-45-6789"
    kinds = [(s.kind, s.score) for s in pii.find_spans(text) if s.kind not in pii.BASE_KINDS]
    assert kinds == [("iban", 1.0), ("ssn", 0.6), ("ssn", 0.6)]
    assert not [s for s in pii.find_spans("no 123-45-6789") if s.kind == "ssn"]


def test_ibans_before_other_words():
    one, two, three = "DE89370400440532013000", "GB82 WEST 1234 5698 7654 32", "NO9386011117947"
    behind = (" BIC COBADEFFXXX", " Thanks", " Please", " EUR 50", " 2024-01-01", " 7", f" {three}")
    for iban in (one, two, three):
        for after in ("", *behind, " and", ".", "é"):
            text = f"IBAN {iban}{after}"
            found = [text[s.start : s.end] for s in pii.find_spans(text) if s.kind == "iban"]
            assert found == [iban, three][: 1 + (three in after)], text
    # a failed start hides none behind it; a number with one more sign is none
    text = f"AB12 {one}, {one}X {one}x {one[:-1]}1 {two}"
    assert [text[s.start : s.end] for s in pii.find_spans(text) if s.kind == "iban"] == [one, two]
    # the length of the country goes before a longer end that passes too
    longer = next(w for w in map(str, range(100)) if pii.mod97(one + w))
    (span,) = [s for s in pii.find_spans(f"{one} {longer}") if s.kind == "iban"]
    assert span.end == len(one)
    # where no length is known, the farthest end that passes counts
    head = next(f"ZZ{n:02}" for n in range(100) if pii.mod97(f"ZZ{n:02}" + "1" * 12))
    tail = next(w for w in map(str, range(100)) if pii.mod97(head + "1" * 12 + w))
    text = f"{head}{'1' * 12} {tail}"
    (span,) = [s for s in pii.find_spans(text) if s.kind == "iban"]
    assert span.end == len(text)
    for bad in ("AB12 " * 20000, "AB12" * 25000, "AB12" + " 1" * 50000, "AB12 1 1 1 1 1 1 1 1 1 1 1 " * 4000):
        pii.find_spans(bad)


def test_pii_rows(docs, empty, saved):
    assert pii.find_pii(docs).count() == docs.count()
    assert pii.find_pii(empty).count() == 0
    rows = saved([(1, "x a@b.co 😀 +49 30 1234567.", "", ""), (2, None, "", "")])
    found = pii.find_pii(rows).orderBy("doc_id").select("spans", pii.redacted("text", "spans").alias("t"))
    assert [r.t for r in found.collect()] == ["x [email] 😀 [phone].", None]
    assert "text" not in pii.find_pii(rows, keep_text=False).columns


def plain_tokens(word, scores):
    best = [(0, 0)]
    for end in range(1, len(word) + 1):
        best.append(
            max(
                (best[i][0] + scores[word[i:end]], best[i][1] - 1)
                for i in range(end)
                if word[i:end] in scores
            )
        )
    return -best[-1][1]


def test_trie_counts_are_those_of_each_word():
    draw = random.Random(4)
    ranks = {bytes([b]): b for b in range(97, 101)}
    for _ in range(60):
        ranks.setdefault(bytes(draw.choice(b"abcd") for _ in range(draw.randrange(2, 6))), 200 + len(ranks))
    scores = token_counts.zipf_scores(ranks)
    words = sorted({bytes(draw.choice(b"abcde") for _ in range(draw.randrange(1, 12))) for _ in range(800)})
    found = token_counts.terminal_counts(words, scores)
    assert found == [plain_tokens(w, scores) for w in words]
    assert token_counts.terminal_counts([], scores) == []
    # an independent library finds cuts of the same score
    model = Tokenizer(models.Unigram([(k.decode("latin-1"), v / 1024) for k, v in scores.items()], 0, False))
    for word in words[:200]:
        pieces = [t.encode("latin-1") for t in model.encode(word.decode()).tokens]
        cut = [b"".join(pieces[:i]) for i in range(len(pieces) + 1)]
        assert cut[-1] == word
        mine = token_counts.terminal_counts([word], scores)[0]
        assert sum(scores[p] for p in pieces) <= 0 and mine <= len(pieces) + 1


def test_token_count_rows(docs, empty, monkeypatch):
    monkeypatch.setattr(token_counts, "REMEMBERED", 3)
    rows = token_counts.count_tokens(docs, RANKS, public_tokenizers.PATTERN).collect()
    assert len(rows) == docs.count()
    assert {(r.n_pretokens, r.n_tokens) for r in rows if not r.text} == {(0, 0)}
    (long,) = [r for r in rows if r.doc_id == 10]
    assert long.n_pretokens == 30_001 and long.n_tokens >= long.n_pretokens
    assert token_counts.count_tokens(empty, RANKS, public_tokenizers.PATTERN).count() == 0


def test_ngram_counts_do_not_depend_on_slices(monkeypatch):
    text = "Größe, naïve 123 — 日本語 abc " * 20
    whole = langid.counts(text)
    monkeypatch.setattr(langid, "SLICE_BYTES", 11)
    assert (langid.counts(text) == whole).all()
    assert langid.counts("").sum() > 0


def test_temperature_and_penalty():
    draw = np.random.default_rng(2)
    labels = draw.integers(0, 2, 4000)
    right = draw.random(4000) < 0.8
    scores = np.zeros((4000, 2))
    scores[np.arange(4000), np.where(right, labels, 1 - labels)] = 10.0
    # 80 % right with a margin of 10 means a temperature of 10 / ln 4
    assert abs(langid.fit_temperature(scores, labels) - 10 / np.log(4)) < 0.6
    rows = [(np.array([i % 2, langid.BUCKETS]), np.array([1.0, 1.0])) for i in range(400)]
    weights = langid.ftrl(rows, np.arange(400) % 2, 2)
    assert weights[0, 0] > 0 > weights[1, 0] and not weights[2:-1].any()


def test_language_rows(docs, empty, spark):
    table = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = langid.train(table.filter(~langid.held_out()))
    held = langid.predict(table.filter(langid.held_out()), model)
    right = held.filter("lang = lang_pred").count() / held.count()
    assert right >= 0.95
    rows = langid.predict(docs, model).collect()
    assert len(rows) == docs.count()
    unknown = {(r.lang_pred, r.lang_score) for r in rows if r.doc_id in (4, 5, 6, 7)}
    assert unknown == {("und", 0.0)}
    assert all(0 <= r.lang_score <= 1 for r in rows)
    none = langid.train(empty)
    assert {r.lang_pred for r in langid.predict(docs, none).collect()} == {"und"}
    assert langid.predict(empty, model).count() == 0

