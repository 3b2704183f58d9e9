"""Secrets, collocations and spelling variants against plain versions."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
from conftest import plan_of
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from footfall.llm import collocations, queries, secret_scan, variants
from footfall.llm.secret_scan import RULES, Rule, scan_secrets
from llm.conftest import SF_DIR

PLAIN = {
    "assign": r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": r"AKIA[A-Z0-9]+",
    "hex": r"[0-9a-f]+",
}


def plain_secrets(text):
    """(kind, start, end) of the base kinds, as they are defined."""
    found = []
    for order, (kind, pattern) in enumerate(PLAIN.items()):
        flags = re.IGNORECASE | re.ASCII if kind == "assign" else 0
        for m in re.finditer(pattern, text or "", flags):
            size = len(m[2]) if kind == "assign" else len(m[0])
            if size >= {"assign": 8, "access": 16, "hex": 32}[kind]:
                found.append((m.start(), order, m.end(), kind))
    return [(kind, start, end) for start, _, end, kind in sorted(found)]


SECRETS = [
    "secret=token:abcdefgh12 password = 'short' Token=\"abcdefgh\"",
    "😀é password:=abcdefgh api_key=12345678 APIKEY: x_x_x_x_x passwd==abcdefg",
    "AKIA" + "A" * 12 + " AKIA" + "B" * 11 + " xAKIAAKIAAKIAAKIA1 " + "0123456789abcdef" * 2,
    "f" * 31 + "g" + "f" * 32 + "\n" + "a" * 5_000,
    "token=" + "x" * 9 + " ghp_" + "a1B2" * 9 + " xoxb-1234567890-abc",
    "-----BEGIN RSA PRIVATE KEY-----\n-----BEGIN PRIVATE KEY-----",
    "ſecret=abcdefgh toKen=abcdefgh \U0001f9ff token=abcdefgh",
    ", ".join(f"token=abcdefgh{i}" for i in range(2000)),
]


def spans_of(rows):
    return {r.doc_id: [tuple(s) for s in r.spans] for r in rows}


def test_secrets_are_those_of_the_definition(saved, folder):
    texts = [*SECRETS, *SECRETS, None, ""]
    rows = [(i, t, "en", "a") for i, t in enumerate(texts)]
    found = spans_of(scan_secrets(saved(rows), folder("ledger"), "source", "doc_id").collect())
    for i, text in enumerate(texts):
        assert [s for s in found[i] if s[0] in PLAIN] == plain_secrets(text), text
    kinds = {i: [s[0] for s in spans if s[0] not in PLAIN] for i, spans in found.items()}
    assert kinds[4] == ["github", "slack"] and kinds[5] == ["private_key"] * 2
    assert SECRETS[4][found[4][1][1] : found[4][1][2]].startswith("ghp_")


def test_secret_query(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    for r in queries.QUERIES["op13_secret_scan"](spark, SF_DIR).collect():
        wanted = plain_secrets(texts[r.doc_id])
        joined = ",".join(":".join(map(str, s)) for s in wanted)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(
            sum(s[0] == kind for s in wanted) for kind in PLAIN
        )


def test_ledger_scans_only_what_is_new(saved, folder, spark, monkeypatch):
    scanned = []
    real = secret_scan.find_spans

    def watched(texts, rules):
        scanned.append(sorted((r.text, len(r.missing)) for r in texts.collect()))
        return real(texts, rules)

    monkeypatch.setattr(secret_scan, "find_spans", watched)
    ledger = folder("ledger")
    scan = lambda rows, rules=RULES: spans_of(
        scan_secrets(saved(rows), ledger, "source", "doc_id", rules=rules).collect()
    )
    first = [(1, "token=abcdefgh", "en", "a"), (2, "nothing", "en", "a"), (3, "token=abcdefgh", "en", "b")]
    assert scan(first)[3] == [("assign", 0, 14)]
    later = [*first, (4, "nothing", "en", "c"), (5, "AKIA" + "Z" * 12, "en", "a")]
    assert scan(later)[5] == [("access", 0, 16)] and scan(later)[1] == [("assign", 0, 14)]
    # A rule that changes is searched for again, alone; what its old version found is left out.
    changed = [Rule("assign", 2, r"token=[a-z]{4}"), *RULES[1:]]
    assert scan(later, changed)[1] == [("assign", 0, 10)]
    assert scan(later)[1] == [("assign", 0, 14)]
    every = len(RULES)
    assert scanned == [
        [("nothing", every), ("token=abcdefgh", every)],
        [("AKIA" + "Z" * 12, every)],
        [],
        [("AKIA" + "Z" * 12, 1), ("nothing", 1), ("token=abcdefgh", 1)],
        [],
    ]
    secret_scan.compact_ledger(spark, ledger)
    assert scan(later)[3] == [("assign", 0, 14)] and scanned[-1] == []
    assert secret_scan.read_ledger(spark, ledger).groupBy("blob").count().filter("count > 1").isEmpty()


def test_secret_rows_and_plan(docs, empty, folder):
    found = scan_secrets(docs, folder("ledger"), "source", "doc_id")
    assert found.count() == docs.count()
    assert set(found.columns) - set(docs.columns) == {"blob"} and "text" not in found.columns
    for slow in ("Python", "Arrow", "Pandas", "Cartesian", "NestedLoop"):
        assert slow not in plan_of(found)
    assert scan_secrets(empty, folder("ledger"), "source", "doc_id").count() == 0


# Collocations


def plain_collocations(rows, max_words, min_count, top):
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    f, total = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(lower)):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            for size in range(1, max_words + 1):
                for i in range(len(words) - size + 1):
                    f[lang, tuple(words[i : i + size])] += 1
    candidates = {k: n for k, n in f.items() if len(k[1]) > 1 and n >= min_count}
    inner = set()
    for (lang, words), n in candidates.items():
        for size in range(2, len(words)):
            for i in range(len(words) - size + 1):
                part = (lang, words[i : i + size])
                if n >= f[part]:
                    inner.add(part)
    best = defaultdict(list)
    for (lang, words), a in candidates.items():
        if (lang, words) not in inner:
            cuts = []
            for k in range(1, len(words)):
                left, right = f[lang, words[:k]], f[lang, words[k:]]
                cuts.append((1000 * a * total[lang] // (left * right), k, left, right))
            score, _, left, right = min(cuts)
            phrase = " ".join(words)
            best[lang].append((-score, -a, phrase.encode(), phrase, left, right))
    return {
        (lang, rank, phrase, -a, left, right, total[lang], -score)
        for lang, found in best.items()
        for rank, (score, a, _, phrase, left, right) in enumerate(sorted(found)[:top], 1)
    }


def _phrase_rows(seed, n=120):
    draw = random.Random(seed)
    words = ["the"] * 20 + ["Of", "\x01a", "é", "É", "b-c", "new", "york", "city"] * 2 + ["\U0001f9ff"]
    rows = [
        (draw.choice(["en", "de", None]), "".join(
            draw.choice(words) + draw.choice([" "] * 6 + ["\t ", ", ", "\n", ".", " \r"])
            for _ in range(draw.randrange(40))
        ))
        for _ in range(n)
    ]
    return [*rows, ("en", None), ("en", ""), ("fr", " . ;"), ("en", "new york city " * 50)]


@pytest.mark.parametrize("parts", [1, 7])
def test_collocations_are_those_of_the_definition(saved, monkeypatch, parts):
    monkeypatch.setattr(collocations, "STREAM_PARTS", parts)
    monkeypatch.setattr(collocations, "GATHERED", 10 * parts)
    rows = _phrase_rows(parts)
    table = saved([(i, t, lang, "a") for i, (lang, t) in enumerate(rows)])
    for top in (5, None):
        found = collocations.collocations(table, min_count=4, top=top, filter_bits=1 << 15)
        wanted = plain_collocations(rows, 5, 4, top)
        assert len(wanted) > 3 and {tuple(r) for r in found.collect()} == wanted
        assert found.count() == len(wanted)


def test_small_slices_change_nothing(monkeypatch):
    text = ("new york city, the end. " * 9 + "x" * 90 + " y").encode()
    monkeypatch.setattr(collocations, "SLICE_BYTES", 40)
    cut = list(collocations._cut(text))
    assert b"".join(cut) == text and len(cut) > 4
    assert all(part[-1:] in b".," for part in cut[:-1])
    assert list(collocations._cut(b"")) == []


def test_filter_holds_every_word(spark):
    draw = random.Random(1)
    hashes = [draw.randrange(-(2**63), 2**63) for _ in range(500)]
    frame = spark.createDataFrame([(h,) for h in hashes], "hash long")
    bits = np.frombuffer(
        collocations.bitmap(collocations.bits_of_words(frame, 1 << 17), 1 << 17), np.uint8
    )
    assert collocations._has(bits, np.array(hashes, np.int64).view(np.uint64)).all()
    assert int(np.unpackbits(bits).sum()) <= 500


def test_collocation_edges(docs, empty):
    found = collocations.collocations(docs, min_count=2)
    assert {r.lang for r in found.collect()} <= {"en", "de", "und"}
    assert ("de", "wort wort wort wort wort", 29996) in {(r.lang, r.phrase, r.a) for r in found.collect()}
    assert collocations.collocations(empty).count() == 0


# Spelling variants


def plain_variants(rows, min_length, min_count, times, damage):
    found = Counter()
    for id_, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if id_ is None else id_}:{run}".encode())
            if h % damage == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            found[run] += 1
    words = {w: n for w, n in found.items() if len(w) >= min_length and n >= min_count}
    near = {w: set() for w in words}
    for a, b in combinations(words, 2):
        if one_edit(a, b):
            near[a].add(b)
            near[b].add(a)
    form = {}
    for w, others in near.items():
        if others:
            best = min(others, key=lambda x: (-words[x], x))
            if words[best] >= times * words[w]:
                form[w] = best
    out = set()
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root]
        out.add((w, n, len(near[w]), form.get(w), words.get(form.get(w)), root))
    return out


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    return a[i + (len(a) == len(b)) :] == b[i + 1 :]


def _word_rows(seed):
    draw = random.Random(seed)
    letters = "aabbcnÉé"
    stems = ["".join(draw.choice(letters) for _ in range(draw.randrange(5, 12))) for _ in range(12)]
    stems += ["aaaaaa", "aaaaaaa", "ababab", "abababab", "Übermut", "ananas"]
    rows = []
    for i in range(60):
        words = []
        for _ in range(30):
            word = draw.choice(stems)
            if draw.random() < 0.4:
                at = draw.randrange(len(word))
                word = word[:at] + draw.choice(["", "a", "b", "é"]) + word[at + draw.randrange(2) :]
            words.append(word)
        rows.append((draw.choice([i, i, None]), draw.choice([" ", "1", "_"]).join(words)))
    return [*rows, (1, None), (2, ""), (3, "a" * 3000)]


@pytest.mark.parametrize("seed", [1, 2])
def test_variants_are_those_of_the_definition(saved, monkeypatch, seed):
    monkeypatch.setattr(variants, "BLOCK_ROWS", 20)
    monkeypatch.setattr(variants, "SLICE_CHARS", 50)
    rows = _word_rows(seed)
    table = saved([(i, t, "en", "a") for i, t in rows])
    found = variants.group_variants(table, min_count=1, times=2, damage=7)
    wanted = plain_variants(rows, 6, 1, 2, 7)
    assert {tuple(r) for r in found.collect()} == wanted and found.count() == len(wanted)
    assert any(w[3] and w[3] != w[5] for w in wanted)  # some forms have forms


@settings(max_examples=200, deadline=None)
@given(st.text("abcd", min_size=6, max_size=12), st.randoms(use_true_random=False))
def test_pivots_are_the_rarest_choice(word, draw):
    grams = [a + b for a in "abcd" for b in "abcd"]
    draw.shuffle(grams)
    order = {g: (i, i * i + 1) for i, g in enumerate(grams)}
    prefix, pivots = variants.signature(word, order)
    weight = {i: order[word[i : i + 2]][1] for _, i in prefix}
    best = min(weight[a] + weight[b] for a, b in combinations(weight, 2) if abs(a - b) >= 2)
    assert sum(weight[i] for _, i in pivots) == best and set(pivots) <= set(prefix)
    assert abs(pivots[0][1] - pivots[1][1]) >= 2 and len(prefix) >= 3


def test_variant_edges(docs, empty):
    found = {r.word: r for r in variants.group_variants(docs, min_count=2).collect()}
    assert variants.group_variants(empty).count() == 0
    with pytest.raises(ValueError):
        variants.group_variants(docs, min_length=3)
    assert found["zeilen"].n == 2 and found["zeilen"].form is None and found["zeilen"].n_near == 0


def test_triples_are_counted_only_where_their_pairs_are_frequent(saved):
    texts = saved([("xx", "a b c. " * 5 + "d e. " * 5 + "a b e. c d e.")], "lang string, text string")
    context, bits = texts.sparkSession.sparkContext, 1 << 15
    words = collocations.count_words(texts).groupBy("lang", "word").agg(F.sum("n").alias("n"))
    named, seed = collocations.named_words(words.filter("n >= 5"))
    known = context.broadcast(collocations.bitmap(collocations.bits_of_words(named, bits), bits))
    pairs = collocations.count_pairs(texts, known, seed).filter("n >= 5")
    assert sorted(row.n for row in pairs.collect()) == [5, 6, 6]
    of_pairs = collocations.bitmap(collocations.bits_of_pairs(pairs, bits), bits)
    triples = collocations.count_triples(texts, known, context.broadcast(of_pairs), seed)
    assert [row.n for row in triples.collect()] == [5]


def test_a_task_hands_on_small_batches(monkeypatch):
    monkeypatch.setattr(collocations, "HANDED_ROWS", 7)
    rows = pa.RecordBatch.from_pydict({"a": list(range(30)), "n": [1] * 30})
    merged = list(collocations.merged(iter([rows, rows]), "a"))
    assert all(batch.num_rows <= 7 for batch in merged)
    assert sorted(n for batch in merged for n in batch.column(1).to_pylist()) == [2] * 30
    assert [b.num_rows for b in collocations.in_parts(rows)] == [7, 7, 7, 7, 2]


def test_buckets_and_pairs_are_handed_on_packed(saved, monkeypatch):
    # Eight pieces of text, each a slice; rare pairs and triples differ from slice to slice.
    rows = [("xx", f"a b c. a b c. {i}x {i}y {i}z. a {i}y. " * 3) for i in range(8)]
    texts = saved(rows, "lang string, text string", files=1)
    monkeypatch.setattr(collocations, "SLICE_BYTES", 40)
    context, bits = texts.sparkSession.sparkContext, 1 << 15
    words = collocations.count_words(texts).groupBy("lang", "word").agg(F.sum("n").alias("n"))
    named, seed = collocations.named_words(words)
    known = context.broadcast(collocations.bitmap(collocations.bits_of_words(named, bits), bits))
    buckets = collocations.bucket_pairs(texts, known, seed)
    # 2 + 8 * 3 pairs: a row each would be 26 from each task, at least; here a row has many.
    entries = [np.frombuffer(r.entries, np.uint32) for r in buckets.collect()]
    assert sum(int((x & 255).sum()) for x in entries) == 8 * 3 * 7
    frequent = collocations.frequent_buckets(buckets, 48, bits)
    likely = context.broadcast(collocations.bitmap(frequent, bits))
    assert frequent.count() == 2
    exact = collocations.count_likely_pairs(texts, known, likely, seed)
    found = collocations.frequent_pairs(exact, 48).collect()
    plain = collocations.count_pairs(texts, known, seed).groupBy("a", "b").agg(F.sum("n").alias("n"))
    assert sorted(found) == sorted(plain.filter("n >= 48").collect()) and len(found) == 2
    both = context.broadcast(
        collocations.bitmap(collocations.bits_of_pairs(plain.filter("n >= 48"), bits), bits)
    )
    triples = collocations.bucket_triples(texts, known, both, seed)
    assert collocations.frequent_buckets(triples, 48, bits).count() == 1


def test_packed_counts_lose_none_beyond_a_byte(spark):
    hashes = [np.repeat(np.arange(n, dtype=np.uint64) << np.uint64(33 + 18), 200) for n in (9, 5)]
    batches = list(collocations.packed(iter([*hashes, hashes[1][:1]])))
    assert sum(batch.num_rows for batch in batches) == 2  # parts, for nine buckets
    counts = spark.createDataFrame(pa.Table.from_batches(batches))
    for least, wanted in ((200, 9), (201, 5), (255, 5), (401, 0), (9999, 0)):
        frequent = collocations.frequent_buckets(counts, least, 1 << 31)
        # Beyond a byte a bucket may pass in vain, but none is lost.
        assert frequent.count() == (wanted if least <= 255 else 5)
    assert {r.bit for r in frequent.collect()} == {i << 18 for i in range(5)}


def test_rare_pairs_make_no_rows(spark, saved, monkeypatch):
    # Every pair is rare but one; a row for each of them would be a thousand.
    draw = random.Random(3)
    words = [f"w{i}" for i in range(40)]
    rows = [("en", " ".join(draw.choices(words, k=60)) + ". new york.") for _ in range(40)]
    texts = saved([(i, t, lang, "a") for i, (lang, t) in enumerate(rows)])
    sizes, plain = [], collocations.frequent_pairs

    def counted(counts, min_count):
        sizes.append(counts.select((F.length("entries") / 24).alias("n")).agg(F.sum("n")).first()[0])
        return plain(counts, min_count)

    monkeypatch.setattr(collocations, "frequent_pairs", counted)
    found = collocations.collocations(texts, min_count=30).collect()
    assert {tuple(r) for r in found} == plain_collocations(rows, 5, 30, 2000)
    assert [r.phrase for r in found] == ["new york"] and sizes[0] <= 10
