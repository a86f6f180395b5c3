import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from terroir.llm.packing import Packer, TokenCache, pack

PATH = public_tokenizers.path("word_bpe_49k.json")
SIZE = 4096


def _plain(texts):
    found = Tokenizer.from_file(PATH).encode_batch([t or "" for t in texts], add_special_tokens=False)
    return [np.array(f.ids + [2], "<u4") for f in found]


def _check(rows, docs):
    """Every id in one piece, checksums right, sequences gapless; the padding as a share of the ids."""
    ids = dict(zip([d[0] for d in docs], _plain([d[1] for d in docs])))
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append(r)
    assert set(by_doc) == set(ids)
    for doc, pieces in by_doc.items():
        at = 0
        for r in sorted(pieces, key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids[doc])
            assert r["ids_crc32"] == zlib.crc32(ids[doc][at : at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(ids[doc])
    padding = 0
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at and r["length"] > 0
            at += r["length"]
        assert at <= SIZE
        padding += 0 if at & (at - 1) == 0 else SIZE - at
    return padding / sum(len(x) for x in ids.values())


def test_round_trip(spark):
    rng = random.Random(5)
    docs = [(i, " ".join(rng.choice(["alpha", "beta,", "Gamma.", "d" * 9]) for _ in range(rng.randrange(1, 9000 if i % 40 == 0 else 900)))) for i in range(300)]
    got = pack(spark.createDataFrame(docs, "doc_id long, text string").repartition(3), PATH).collect()
    assert _check(got, docs) == 0


def test_odd_documents(spark, odd_docs, no_docs, clashing):
    docs = [(r["doc_id"], r["text"]) for r in odd_docs.where("doc_id IS NOT NULL").distinct().collect()]
    for frame in (odd_docs, clashing):
        once = frame.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
        assert _check(pack(once, PATH).collect(), docs) == 0
        everything = pack(frame, PATH).collect()
        assert len({r["sequence_id"] for r in everything}) < len(everything)
        assert sorted(r["doc_tokens"] for r in everything if r["doc_id"] is None)[0] == 1
        assert sum(r["length"] for r in everything if r["doc_id"] == 5) == 4
    assert pack(no_docs, PATH).count() == 0


def test_cache_equals_tokenizer():
    rng = random.Random(6)
    signs = ["a", "É", "é", "́", "ß", "İ", "ﬁ", "Σ", "ς", "'s", "’", "don't", "12", "#", "...", ",", ".", " ", " ", "\x1c", "\x85", "\t", "\n",
             " ", "日本", "\U0001f642", "عربي", "<|endoftext|>", "<|EndOfText|>", "<", "|", "Word", "!!", "²", "_", "‍", "﻿"]
    texts = ["".join(rng.choice(signs) for _ in range(rng.randrange(50))) for _ in range(3000)] + [None]
    cache = TokenCache(Tokenizer.from_file(PATH), limit=100)
    for k in range(0, len(texts), 200):
        for text, got in zip(texts[k : k + 200], cache.encode(texts[k : k + 200]), strict=True):
            assert np.frombuffer(got + b"\2\0\0\0", "<u4").tolist() == _plain([text])[0].tolist() if k < 400 else True
    plain = _plain(texts)
    fresh = TokenCache(Tokenizer.from_file(PATH)).encode(texts)
    assert all(got + b"\2\0\0\0" == want.tobytes() for got, want in zip(fresh, plain, strict=True))


def test_sum_of_squares_rule():
    """Each piece goes where the sum of squares becomes least, by trying every level."""
    rng = random.Random(7)
    packer = Packer(32, 0)
    for doc in range(400):
        before, length = packer.counts.copy(), rng.randrange(1, 32)
        packer.add(doc, bytes(4 * length))
        best = None
        for level in range(0, 33 - length):
            if level and not before[level]:
                continue
            after = before.copy()
            after[level] -= level > 0
            after[level + length] += level + length < 32
            best = min(x for x in (best, (after**2).sum()) if x is not None)
        assert (packer.counts**2).sum() == best
    packer.finish()
    assert sum(r[2] for r in packer.rows) > 0 and not packer.open
