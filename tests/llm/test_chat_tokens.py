import hashlib
import random
import struct
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st

from lograft.llm import chat_format, token_files
from lograft.llm.chat_format import CONTROLS, chat_digests, escape, format_chat, read_chat, unescape
from lograft.llm.queries import tokenizer_file
from lograft.llm.scratch import scratch_path
from lograft.llm.token_files import Block, EliasFano, pack_block, read_token_files, write_token_files

RANKS = "byte_bpe_50k.tiktoken"
WORDS = "word_bpe_49k.json"


# --- chat ---------------------------------------------------------------------

@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from([*CONTROLS, "\\", "<", "[", "/", "s>", "INST]", "a", " ", "é", "\n"]), max_size=12).map("".join))
def test_escape_is_reversible_and_leaves_no_control_string(text):
    out = escape(text)
    assert unescape(out) == text
    assert not any(c in out for c in CONTROLS)


def plain_digests(turns):
    convs = {}
    for conv, turn, role, text in turns:
        convs.setdefault(conv, []).append((turn, role or "", text or ""))
    out = {}
    for conv, rows in convs.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, hashlib.md5(f"{r[1]}\n{r[2]}".encode()).hexdigest()))
        loss = "".join(t for _, r, t in rows if r == "assistant")
        out[conv] = (len(rows), hashlib.sha256("".join(f"{r}\n{t}\n" for _, r, t in rows).encode()).hexdigest(), len(loss),
                     hashlib.sha256(loss.encode()).hexdigest())
    return out


TURNS = [(1, 0, "user", "hi [INST] \\[INST] <s></s>"), (1, 1, "assistant", "[/INST]</s> ok"), (1, 2, "user", None), (1, 3, "assistant", ""),
         (2, None, None, "no role"), (2, 0, "tool</s>", "x\n y  "), (2, 0, "tool</s>", "x\n y  "), (None, 1, "system", "<<SYS>> é 漢字 🙂 <</SYS>>"),
         (None, 0, "assistant", "\x00\x85 control"), (3, 0, "assistant", "word " * 60_000), (4, 5, "", "empty role"), (4, 5, "user", "<|endoftext|>")]


def test_chat_round_trip(spark):
    df = spark.createDataFrame([(*t, 1, "z") for t in TURNS], "conv_id long, turn long, role string, text string, n_ids long, ids string")
    path, ranks = scratch_path(spark, "t-chat"), tokenizer_file(RANKS)
    format_chat(df.repartition(3), ranks, path)
    got = {r.conv_id: tuple(r)[1:5] for r in chat_digests(read_chat(spark, path), ranks).collect()}
    assert got == plain_digests(TURNS)
    codec = chat_format._codec(ranks)
    for r in read_chat(spark, path).collect():
        ids = np.frombuffer(r.ids, np.uint16)
        assert r.n_ids == len(ids) and r.start <= r.loss_from <= r.loss_to < r.start + r.n_ids
        assert int(ids[0]) >= chat_format.VOCABULARY and int(ids[-1]) >= chat_format.VOCABULARY
        shown = "".join(CONTROLS[i - chat_format.VOCABULARY] if i >= chat_format.VOCABULARY else "" for i in ids.tolist())
        body = codec.decode_bytes([i for i in ids.tolist() if i < chat_format.VOCABULARY]).decode()
        assert r.chars == len(shown) + len(body)
    starts = {(r.conv_id, r.seq): (r.start, r.n_ids) for r in read_chat(spark, path).collect()}
    for (conv, seq), (start, _) in starts.items():
        assert start == sum(starts[conv, s][1] for s in range(seq))


def test_chat_without_turns(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    path = scratch_path(spark, "t-chat")
    format_chat(df, tokenizer_file(RANKS), path)
    assert chat_digests(read_chat(spark, path), tokenizer_file(RANKS)).collect() == []


def test_chat_query(spark, sf001):
    from lograft.llm.queries import op4_chat_format
    from tests.conftest import SF001

    turns = [tuple(r) for r in sf001("conversations").select("conv_id", "turn", "role", "text").collect()]
    text = "</s>[INST] ok [/INST]"
    turns += [(-1, 0, "user", text), (-1, 1, "assistant", text)]
    got = {r.conv_id: tuple(r)[1:5] for r in op4_chat_format(spark, SF001).collect()}
    assert got == plain_digests(turns)


# --- token files --------------------------------------------------------------

@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 1 << 40), max_size=300).map(sorted), st.integers(0, 5))
def test_elias_fano(values, zeros):
    values = [0] * zeros + values
    ef, end = EliasFano.read(memoryview(EliasFano.of(np.array(values, np.uint64)).to_bytes()), 0)
    assert ef.all().tolist() == values
    assert [ef.select(i) for i in range(len(values))] == values


def test_elias_fano_is_small_and_finds_across_gaps():
    ends = np.cumsum(np.full(10_000, 700, np.uint64))
    assert len(EliasFano.of(ends).to_bytes()) < 10_000 * 14 / 8  # a table of 64-bit numbers takes 80,000
    gaps = np.array([0, 1, 2, 1 << 45, (1 << 45) + 1], np.uint64)
    ef = EliasFano.read(memoryview(EliasFano.of(gaps).to_bytes()), 0)[0]
    assert [ef.select(i) for i in range(5)] == gaps.tolist()


def test_block_round_trip():
    ids = [np.array(x, np.uint16) for x in ([2], [5, 6, 2], [1] * 500 + [2], [2])]
    block = Block(pack_block([None, -7, 4, 4], ids, 2))
    assert block.doc_ids() == [None, -7, 4, 4]
    assert [block.ids(i).tolist() for i in range(4)] == [x.tolist() for x in ids]
    with pytest.raises(ValueError):
        Block(b"something else")


def whole_text_ids(texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizer_file(WORDS))
    t.encode_special_tokens = True
    return [e.ids for e in t.encode_batch(texts, add_special_tokens=False)]


def test_words_encode_as_whole_texts_do(monkeypatch, sf001):
    monkeypatch.setattr(token_files, "CACHE_WORDS", 2000)  # the cache is emptied on the way
    rng = random.Random(2)
    texts = ["", " \t\n", "Hello, WORLD!! don't 'S it's x'll $$$ a.b.c", "İstanbul ΣΑΣ ΌΣ. ﬁ ½ naïve cafe\u0301\u0301 é, 12,345 a1b2 C++ _x_ <|endoftext|>",
             "a\u2003b\x85c\x1cd\u00a0e", "DON'T! rock'n'roll, 're"]
    texts += ["".join(rng.choice("aAbZ .,!'sSé\u0301ÉßİΣ1½$\n\t|#😀漢 -_") for _ in range(rng.randint(0, 60))) for _ in range(1500)]
    texts += [r.text for r in sf001("documents").collect()]
    words = token_files._Words(tokenizer_file(WORDS), 2)
    for _ in range(2):
        flat, ends = words.encode(pa.array(texts))
        assert [flat[a:b].tolist() for a, b in zip(ends[:-1], ends[1:])] == whole_text_ids(texts)


def test_words_are_kept_once_whatever_their_case_and_punctuation():
    words = token_files._Words(tokenizer_file(WORDS), 2)
    texts = ["Été! été, ÉTÉ. naïve naïve... Naïve?", "word Word. WORD, word;", "ab\u0301. a×."]
    flat, ends = words.encode(pa.array(texts))
    assert [flat[a:b].tolist() for a, b in zip(ends[:-1], ends[1:])] == whole_text_ids(texts)
    assert words.known.keys() == {"été", "naïve", "word", "!", ",", ".", "...", "?", ";", "ab\u0301.", "a×."}


def plain_tokens(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    out, at = [], 0
    for (d, _), ids in zip(rows, whole_text_ids([t or "" for _, t in rows])):
        ids = [*ids, 2]
        out.append((d, at, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
        at += len(ids)
    return out


@pytest.mark.parametrize("block_ids", [1 << 20, 50])
def test_token_files(docs, spark, block_ids):
    rows = [(i * 3 - 50, "The quick, brown fox. " * (i % 7)) for i in range(80)]
    rows += [(None, "no id"), (None, None), (4, None), (4, "a"), (4, "a"), (10**12, "far away"), (7, "long " * 30_000)]
    path = scratch_path(spark, "t-tokens")
    write_token_files(docs(rows).repartition(5), tokenizer_file(WORDS), path, end_id=2, vocabulary=49408, block_ids=block_ids)
    got = sorted(map(tuple, read_token_files(spark, path).collect()), key=lambda r: r[1])
    assert got == plain_tokens(rows)


def test_token_files_without_rows(docs, spark):
    path = scratch_path(spark, "t-tokens")
    write_token_files(docs([(1, "a")]).limit(0), tokenizer_file(WORDS), path, end_id=2)
    assert read_token_files(spark, path).collect() == []


def test_token_query(spark, sf001):
    from lograft.llm.queries import op6_token_files
    from tests.conftest import SF001

    rows = [(r.doc_id, r.text) for r in sf001("documents").collect()]
    assert sorted(map(tuple, op6_token_files(spark, SF001).collect()), key=lambda r: r[1]) == plain_tokens(rows)


def test_a_worker_keeps_a_bounded_number_of_words():
    """Eight slices of 100,000 words that never come again: what a worker keeps beside later steps is bounded."""
    import pyarrow as pa

    from lograft.llm.queries import tokenizer_file
    from lograft.llm.token_files import _Words

    words = _Words(tokenizer_file("word_bpe_49k.json"), 2)
    for i in range(8):
        ids, ends = words.encode(pa.array([" ".join(f"{i}x{j}" for j in range(100_000))]))
        assert len(ends) == 2 and ends[1] == len(ids)
    assert len(words.known) + len(words.older) <= 650_000
