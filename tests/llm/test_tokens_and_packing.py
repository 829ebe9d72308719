import random
import zlib

import numpy as np
import public_tokenizers
from cases import clashing, edge_texts, frame
from tokenizers import Tokenizer

from stageline.llm.packing import pack_documents, plan, sequences
from stageline.llm.token_counts import quantiles, token_counts
from stageline.llm.tokens import encoder, read_vocabulary

WORD = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def ids(text):
    return WORD.encode(text or "", add_special_tokens=False).ids


def test_fast_encoder_gives_the_same_ids():
    rng = random.Random(5)
    letters = "aA é\n\t 12,.'sß漢字　 ́😀\x00\x1c <|>ÀẞǅⅣ٣"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(60))) for _ in range(3000)]
    texts += ["x<|endoftext|> y", "<|endoftext|>", "I'll don't  we've\n\n  x", "a" * 5000, " " * 300]
    fast = encoder(read_vocabulary())
    assert [t for t in texts if fast(t) != ids(t)] == []


def test_very_long_white_space():
    """Runs over which the fast split would go back place by place give the library's ids."""
    fast = encoder(read_vocabulary())
    n = 2_000_000
    texts = [" " * n, "\n" * n, " \n" * (n // 2), "a " + "\t" * n + " b<|endoftext|>", ("word" + " " * 60_000) * 3 + "\u3000" * 60_000]
    for text in texts:
        assert fast(text) == ids(text)
    assert fast("x" * 300_000) == ids("x" * 300_000)


def test_long_white_space_in_documents(spark):
    texts = ["a b", " " * 1_500_000, "x" + "\n" * 1_200_000 + "y", None]
    rows = pack_documents(frame(spark, texts)).collect()
    assert {r.doc_id: sum(x.length for x in rows if x.doc_id == r.doc_id) for r in rows} == {
        i: len(ids(t)) + 1 for i, t in enumerate(texts)
    }
    counts = token_counts(frame(spark, texts)).collect()
    assert counts


def test_other_vocabularies_go_through_their_library():
    path = public_tokenizers.path("word_bpe_49k.json")
    other = Tokenizer.from_file(path)
    assert encoder(read_vocabulary(path))("Some words, HERE") == other.encode("Some words, HERE", add_special_tokens=False).ids


def check_packing(rows, texts, capacity):
    pieces, seqs = {}, {}
    for r in rows:
        pieces.setdefault(r.doc_id, []).append(r)
        seqs.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in seqs.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= capacity
    for doc, text in enumerate(texts):
        want = [*ids(text), 0]
        own = sorted(pieces.pop(doc), key=lambda r: r.piece)
        assert [r.piece for r in own] == list(range(len(own)))
        assert len(own) == -(-len(want) // capacity) and all(r.length == capacity for r in own[1:])
        at = 0
        for r in own:
            cut = np.array(want[at : at + r.length], "<u4").tobytes()
            assert (r.start, r.ids_crc32) == (at, zlib.crc32(cut))
            at += r.length
        assert at == len(want)
    assert not pieces
    return len(seqs)


def test_packing_is_whole_and_gapless(spark):
    texts = edge_texts() + ["word " * 2047, "word " * 4095]
    docs = frame(spark, texts)
    rows = pack_documents(clashing(docs)).collect()
    n = check_packing(rows, texts, 2048)
    total = sum(len(ids(t)) + 1 for t in texts)
    assert n <= -(-total // 2048) * 1.1 + 1
    assert pack_documents(docs.where("false")).count() == 0
    check_packing(pack_documents(docs, capacity=64).collect(), texts, 64)


def test_sequences_hold_the_ids(spark):
    texts = edge_texts()[:30]
    packed = pack_documents(frame(spark, texts), with_ids=True, capacity=128)
    whole = {r.sequence_id: r.ids for r in sequences(packed).collect()}
    for r in packed.collect():
        assert whole[r.sequence_id][r.offset : r.offset + r.length] == list(r.ids)


def test_plan_uses_each_piece_once_and_wastes_little():
    rng = random.Random(2)
    for shape in ([rng.randrange(1, 2049) for _ in range(50_000)], [2048] * 9, [1] * 5000, [1500] * 10, [int(rng.gammavariate(2, 400)) % 2048 + 1 for _ in range(50_000)]):
        counts = {}
        for n in shape:
            counts[n] = counts.get(n, 0) + 1
        used, n = {}, 0
        for need, repeats in plan(counts):
            assert sum(a * m for a, m in need) <= 2048 and repeats > 0
            n += repeats
            for a, m in need:
                used[a] = used.get(a, 0) + m * repeats
        assert used == counts
        assert n <= max(-(-sum(shape) // 2048) * 1.02 + 1, sum(a > 1024 for a in shape) * 1.005)


def test_hot_length_is_ranked_in_groups(spark):
    texts = ["same words here"] * 2500 + ["other"] * 3
    rows = pack_documents(frame(spark, texts)).collect()
    assert check_packing(rows, texts, 2048) == -(-sum(len(ids(t)) + 1 for t in texts) // 2048)


def test_token_counts(spark):
    texts = edge_texts()
    lengths = sorted(len(ids(t)) for t in texts)
    answers = token_counts(clashing(frame(spark, texts)))
    rows = {r.context_limit: r for r in answers.collect()}
    assert sorted(rows) == sorted(set(lengths))
    for limit, r in rows.items():
        assert r.truncated_total == sum(min(n, limit) for n in lengths)
        assert r.n_docs == lengths.count(limit)
        assert r.n_longer == sum(n > limit for n in lengths)
        assert r.longer_tokens == sum(n for n in lengths if n > limit)
        assert abs(r.share - sum(n <= limit for n in lengths) / len(lengths)) < 1e-12
    got = {r.wanted: r.n_tokens for r in quantiles(answers, [0.1, 0.5, 1.0]).collect()}
    assert got == {s: lengths[max(0, -(-int(s * 1000 * len(lengths)) // 1000) - 1)] for s in (0.1, 0.5, 1.0)}
    assert token_counts(frame(spark, [])).count() == 0
