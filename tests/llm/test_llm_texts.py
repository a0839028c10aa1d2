"""Operators that work text by text, against the libraries and against themselves."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer, models, pre_tokenizers

from worklink.llm import bpe, fingerprints, packing, token_counts

ODD = list("  \n\t'sdtab 　\x1c\x1f\x85é中1９²́😀.,!ªʰΣİ") + ["<|endoftext|>", "<|endof", " the", " \n ", "'ll"]
TEXTS = ["", " ", "\n", "a", "word " * 5000, "x" * 9000, "é" * 5000, "tie tie tie\n\ntie", "<|endoftext|>",
         "Mixed Case, with 123 numbers!\nand a line\n\nmore  double   blanks"]


def random_texts(n, seed, parts=ODD, most=30):
    rng = random.Random(seed)
    return ["".join(rng.choice(parts) for _ in range(rng.randint(0, most))) for _ in range(n)]


def frame(spark, texts, **extra):
    """Rows with clashing extra columns, a null text, a null id and a repeated row."""
    rows = [(i, t, "x", i) for i, t in enumerate(texts)]
    rows += [(len(texts), None, None, None), (None, "no id", "x", 1), rows[0]] if texts else []
    return spark.createDataFrame(rows, "doc_id long, text string, fingerprint string, n_tokens long")


# ------------------------------------------------------------------ byte pairs


@pytest.fixture(scope="module")
def coder():
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        return bpe.BytePairCoder(file.read())


def test_bpe_equals_library(coder):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for text in TEXTS + random_texts(3000, 1):
        ids = library.encode(text, add_special_tokens=False).ids
        assert coder.encode(text) == ids, text
        assert "".join(coder.decode(ids)) == library.decode(ids, skip_special_tokens=False) == text
        assert coder.digest(text) == (
            len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())


def test_bpe_reads_a_known_text_without_tokens(coder):
    """What a digest adds for a part is made once; a text of known parts needs neither pattern nor vocabulary."""
    added = next(iter(coder.added), "")
    text = f"a well-known wörd,  two blanks {added} and 1234 {added}{added}"
    first = coder.digest(text)
    known = bpe.BytePairCoder.__new__(bpe.BytePairCoder)
    known.__setstate__({"added": coder.added})
    known.forms.update(coder.forms)
    assert known.digest(text) == first
    assert coder.forms[" wörd"] == ("".join(f",{i}" for i in coder.encode(" wörd")).encode(), " wörd".encode())


def tiny_coder(merges, block=1):
    """A coder over given merges of byte strings, with an alphabet of all bytes."""
    coder = bpe.BytePairCoder.__new__(bpe.BytePairCoder)
    tokens = [bytes([b]) for b in range(256)]
    for a, b in merges:
        if a + b not in tokens:
            tokens.append(a + b)
    ids = {t: i for i, t in enumerate(tokens)}
    state = {"of_byte": [ids[bytes([b])] for b in range(256)],
             "rank": {(ids[a], ids[b]): r for r, (a, b) in reversed(list(enumerate(merges)))},
             "made": [ids[a + b] for a, b in merges], "bytes_of": {i: t for t, i in ids.items()},
             "lookahead": bpe.sufficient_lookahead(merges), "block": max(block, max(map(len, tokens))), "added": {}, "shown": {}}
    coder.__setstate__(state)
    return coder


@pytest.mark.parametrize("seed", range(40))
def test_bpe_stream_is_stable_behind_the_lookahead(seed):
    """Any chunking gives the tokens of the whole, for random merge lists."""
    rng = random.Random(seed)
    known, merges = [b"a", b"b", b"c"], []
    for _ in range(rng.randint(1, 12)):
        pair = rng.choice(known), rng.choice(known)
        if pair not in merges and pair[0] + pair[1] not in known:
            merges.append(pair)
            known.append(pair[0] + pair[1])
    coder = tiny_coder(merges)
    for _ in range(30):
        data = bytes(rng.choice(b"abc") for _ in range(rng.randint(0, 12 * coder.lookahead + 90)))
        whole = coder.merged(data)
        assert list(coder.stream(data[i:i + 3] for i in range(0, len(data), 3))) == whole
        assert b"".join(coder.bytes_of[t] for t in whole) == data


def test_bpe_lookahead_of_a_chain():
    # (b, c) may take the b that (a, b) would have, and so on to the left
    assert bpe.sufficient_lookahead([(b"b", b"c"), (b"a", b"b")]) == 2
    assert bpe.sufficient_lookahead([(b"a", b"b"), (b"b", b"c")]) == 1
    assert bpe.sufficient_lookahead([]) == 0


def test_bpe_decoder_waits_for_whole_characters(coder):
    ids = coder.encode("é中😀")
    assert len(ids) > 3
    assert "".join(coder.decode(ids)) == "é中😀"
    assert "".join(coder.decode(ids[:1])) in ("é", "�")


def test_bpe_rows(spark):
    found = bpe.bpe_roundtrip(frame(spark, TEXTS), public_tokenizers.path("byte_bpe_50k.json")).collect()
    assert len(found) == len(TEXTS) + 3
    empty = hashlib.sha256(b"").hexdigest()
    assert [tuple(r)[1:] for r in found if r.doc_id == len(TEXTS)] == [(0, empty, empty)]
    assert sum(r.doc_id is None for r in found) == 1
    nothing = bpe.bpe_roundtrip(frame(spark, []), public_tokenizers.path("byte_bpe_50k.json"))
    assert nothing.collect() == [] and nothing.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]


# ------------------------------------------------------------------ token counts


def test_token_counts_equal_library(spark):
    vocabulary = token_counts.read_vocabulary(public_tokenizers.path("piece_bpe_32k.model"))
    counter = token_counts.UnigramCounter(vocabulary)
    library = Tokenizer(models.Unigram(vocabulary, unk_id=0, byte_fallback=True))
    library.pre_tokenizer = pre_tokenizers.Metaspace(replacement="▁", prepend_scheme="always", split=True)
    for text in TEXTS + random_texts(2000, 2, list("  \n\tabcthe▁é中1😀\x00ñ") + ["<0x0A>", "</s>", "<s>"]):
        assert counter.count(text)[0] == len(library.encode(text, add_special_tokens=False).ids), text
    found = token_counts.token_counts(frame(spark, TEXTS), public_tokenizers.path("piece_bpe_32k.model")).collect()
    assert {r.doc_id: r.n_tokens for r in found if r.doc_id is not None} == {
        **{i: counter.count(t)[0] for i, t in enumerate(TEXTS)}, len(TEXTS): 0}
    assert token_counts.token_counts(frame(spark, []), public_tokenizers.path("piece_bpe_32k.model")).count() == 0


@pytest.mark.parametrize("seed", range(8))
def test_token_counts_ties(seed):
    """Few scores, so many paths tie; unknown characters count as one piece per run."""
    rng = random.Random(seed)
    pieces = ["▁", "a", "b", "ab", "ba", "aab", "▁a", "abb", "bb"]
    vocabulary = [("<unk>", 0.0)] + [(p, rng.choice([-1.0, -1.5, -2.25])) for p in pieces]
    counter = token_counts.UnigramCounter(vocabulary)
    library = Tokenizer(models.Unigram(vocabulary, unk_id=0, byte_fallback=False))
    library.pre_tokenizer = pre_tokenizers.Metaspace(replacement="▁", prepend_scheme="always", split=True)
    for text in random_texts(400, seed, list("ab zy")):
        assert counter.count(text)[0] == len(library.encode(text).ids), text


# ------------------------------------------------------------------ packing


def test_shortest_pack_first_uses_every_piece():
    rng = random.Random(0)
    for _ in range(50):
        size = rng.choice([8, 64, 2048])
        histogram = {rng.randint(1, size): rng.randint(1, 1000) for _ in range(rng.randint(0, 60))}
        patterns = packing.shortest_pack_first(histogram, size)
        used = {}
        for p in patterns:
            assert 0 < sum(p.lengths) <= size and p.count > 0
            for length in p.lengths:
                used[length] = used.get(length, 0) + p.count
        assert used == histogram


def test_pack_rows(spark):
    path = public_tokenizers.path("word_bpe_49k.json")
    texts = TEXTS + random_texts(200, 3) + ["same words again"] * 300
    rows = packing.pack(frame(spark, texts), path, size=64, end_id=1, shard_rows=40).collect()
    library = Tokenizer.from_file(path)
    ids = {i: [*library.encode(t, add_special_tokens=False).ids, 1] for i, t in enumerate(texts)}
    ids[len(texts)] = [1]
    ids[None] = [*library.encode("no id", add_special_tokens=False).ids, 1]
    wanted = []
    for key, tokens in [*ids.items(), (0, ids[0])]:
        for start in range(0, len(tokens), 64):
            piece = tokens[start:start + 64]
            wanted.append((key, start, len(piece), zlib.crc32(np.array(piece, "<u4").tobytes()), len(tokens)))
    order = lambda row: tuple(-1 if x is None else x for x in row)
    assert sorted((tuple(r)[:5] for r in rows), key=order) == sorted(wanted, key=order)
    ends = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == ends.get(r.sequence_id, 0)
        ends[r.sequence_id] = r.offset + r.length
    assert max(ends.values()) <= 64
    assert sum(ends.values()) / (64 * len(ends)) > 0.97
    assert packing.pack(frame(spark, []), path).collect() == []


# ------------------------------------------------------------------ fingerprints


def test_fingerprint_is_a_multiset_hash():
    a, b, c = "one line", "another line, longer", "third"
    assert fingerprints.fingerprint(f"{a}\n{b}\n{c}").text() == fingerprints.fingerprint(f"{c}\n{a}\n\n{b}").text()
    assert fingerprints.fingerprint(f"{a}\n{a}").text() != fingerprints.fingerprint(a).text()
    grown = fingerprints.fingerprint(f"{a}\n{c}").add(b)
    assert grown.text() == fingerprints.fingerprint(f"{a}\n{b}\n{c}").text()
    assert grown.add(a, -1).add(b, -1).text() == fingerprints.fingerprint(c).text()
    assert fingerprints.fingerprint("").text() == fingerprints.fingerprint("\n\n").text()
    parsed = fingerprints.MultisetHash.parse(grown.text())
    assert parsed.text() == grown.text() and parsed.likeness(grown) == 1.0
    assert fingerprints.fingerprint("").likeness(fingerprints.fingerprint("")) == 1.0
    assert fingerprints.fingerprint("").likeness(fingerprints.fingerprint("text")) < 0.1


@pytest.mark.parametrize("lines", [400, 40_000])
def test_likeness_of_many_equal_lines(lines):
    # a lane counts more than 32,767 windows in the longer text
    text = "The quick brown fox jumps over the lazy dog and looks at a river bank\n" * lines
    edited = fingerprints.edited_text(text, "".join(f"line {i} of quite another text\n" for i in range(lines)))
    mine, other = fingerprints.fingerprint(text), fingerprints.fingerprint(edited)
    read = [fingerprints.MultisetHash.parse(v.text()) for v in (mine, other)]
    assert mine.likeness(other) > 0.8 and read[0].likeness(read[1]) == mine.likeness(other)


def test_fingerprint_of_long_text_in_steps(monkeypatch):
    text = "".join(random_texts(300, 4))
    whole = fingerprints.fingerprint(text).text()
    monkeypatch.setattr(fingerprints, "STEP", 13)
    assert fingerprints.fingerprint(text).text() == whole


@pytest.mark.parametrize("rows", [3, 2000])
def test_fingerprint_rows(spark, rows):
    texts = TEXTS + random_texts(40, 5)
    data = [(10 * i, t, "x") for i, t in enumerate(texts)] + [(5, None, None), (None, "no id", "x")]
    docs = spark.createDataFrame(random.Random(1).sample(data, len(data)), "doc_id long, text string, fingerprint string")
    found = {r.doc_id: r for r in fingerprints.document_fingerprints(docs, rows=rows).collect()}
    order = sorted(data, key=lambda r: -1 if r[0] is None else r[0])
    assert len(found) == len(order)
    for (key, text, _), (_, following, _) in zip(order, order[1:] + order[:1]):
        text, following = text or "", following or ""
        edited = text[:len(text) - len(text) // 4] + following[:len(text) // 4]
        r = found[key]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert r.fingerprint == fingerprints.fingerprint(text).text()
        assert r.edited_fingerprint == fingerprints.fingerprint(edited).text()
        assert 0 <= r.near_next <= 1 and 0 <= r.near_edited <= 1
        if text == following:
            assert r.near_next == 1.0
    assert fingerprints.document_fingerprints(docs.limit(0)).collect() == []
    one = fingerprints.document_fingerprints(spark.createDataFrame([(1, "only one text")], "doc_id long, text string")).first()
    assert one.near_next == 1.0
    twice = spark.createDataFrame([(1, "same"), (1, "same"), (1, "other")], "doc_id long, text string")
    assert fingerprints.document_fingerprints(twice).count() == 3
