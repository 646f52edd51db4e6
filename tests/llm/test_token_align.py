"""Aligned tokens against a plain encoding of whole texts."""

import hashlib
from collections import Counter

import numpy as np
import pytest

from tidemark.llm import token_align as ta
from tidemark.llm.common import documents

SF = "/root/testdata/sf0.001"
ODD = [(1, None), (2, ""), (3, " \n\t "), (4, "one two"), (4, "one two"), (None, "no id  here"), (6, "word " * 4000), (7, "x" * 5000),
       (8, "Ünïcode ñ 漢字 🙂 " * 30), (9, "a▁b c"), (10, "<|endoftext|> <s> </s> <0x41> \x00 ᠎ x \x85 y  z"),
       (11, "it's  a's 'll we'll\r\n\r\n x\n y"), (12, " lead"), (13, "trail "), (14, " "), (15, "漢字 漢́ é 힣　x y​ \U0001f468‍\U0001f469 z a"),
       (16, "".join(chr(c) + " " for c in range(1, 0x3000)))]


def spans(parts):
    out, at = [], 0
    for p in parts:
        out.append((at, at + len(p)))
        at += len(p)
    return out


def brute(rows):
    """Whole texts, encoded at once; byte offsets from the tokens' bytes alone."""
    import sentencepiece
    import tokenizers
    a = tokenizers.Tokenizer.from_file(f"{ta.TOKENIZERS}/{ta.FILE_A}")
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=f"{ta.TOKENIZERS}/{ta.FILE_B}")
    byte = ta._byte_alphabet()
    found, counts = [], Counter()
    for doc_id, text in rows:
        found.append((doc_id, None))
        if not text:
            continue
        want = (" " + text).encode()
        ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        parts_a = [bytes(byte[c] for c in a.id_to_token(i)) for i in ids_a]
        parts_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
        if b"".join(parts_a) != want or b"".join(parts_b) != want:
            continue
        at_a, at_b = spans(parts_a), spans(parts_b)
        groups, links, i, j = [], [], 0, 0
        for cut in sorted({e for _, e in at_a} & {e for _, e in at_b}):
            x, y = i, j
            while x < len(at_a) and at_a[x][1] <= cut:
                x += 1
            while y < len(at_b) and at_b[y][1] <= cut:
                y += 1
            groups.append(",".join(map(str, ids_a[i:x])) + "|" + ",".join(map(str, ids_b[j:y])))
            links += [(ids_a[p], ids_b[q]) for p in range(i, x) for q in range(j, y)
                      if at_a[p][0] < at_b[q][1] and at_b[q][0] < at_a[p][1]]
            i, j = x, y
        counts.update(links)
        found[-1] = (doc_id, (len(ids_a), len(ids_b), len(groups), links, ";".join(groups)))
    top = Counter()
    for (_, y), n in counts.items():
        top[y] = max(top[y], n)
    return [(d, 0, 0, 0, 0, 0, 0, "") if r is None else
            (d, *r[:3], len(r[3]), sum(counts[p] == top[p[1]] for p in r[3]), sum(counts[p] for p in r[3]), hashlib.sha256(r[4].encode()).hexdigest())
            for d, r in found]


def ordered(rows):
    return sorted(map(tuple, rows), key=lambda r: (r[0] is None, r))


def test_query_equals_whole_texts(spark):
    rows = [tuple(r) for r in documents(spark, SF).select("doc_id", "text").collect()]
    assert ordered(ta.op11_token_align(spark, SF).collect()) == ordered(brute(rows))


@pytest.mark.parametrize("chunk_units", [50, 1 << 20])
def test_odd_texts(spark, chunk_units):
    docs = spark.createDataFrame([(*r, 1, "x", "y") for r in ODD], "doc_id bigint, text string, chunk int, pair string, groups string")
    got = ta.align(docs.repartition(3), chunk_units=chunk_units).collect()
    got = [(*r[:7], hashlib.sha256(r[7].encode()).hexdigest() if r[7] else "") for r in got]
    assert ordered(got) == ordered(brute(ODD))
    assert ta.align(docs.limit(0)).count() == 0


MARKED = [(1, "one, two. three; (four) five_six é, ñ! ó* × ×, don't, we'll. 's. it's\nNew, line.\nNext? ½, a½. a.b,c.\n d,\n\n e.'re x'.\nz"),
          (2, "one two three four, four. four! four\nfour (four four) 漢字, 漢字. e\u0301, \u01c3, \u0250, 1, 2.5 \x00a, \x00, \x1f.\n"), (3, "▁a, b."), (4, "a.\x85b,\u2028c.\nd")]


def test_words_with_marks_are_cut_once_more(spark):
    aligner = ta.Aligner(f"{ta.TOKENIZERS}/{ta.FILE_A}", f"{ta.TOKENIZERS}/{ta.FILE_B}")
    assert aligner.parts("four.\nNew,") == ["four", "\x00.", "\x00\nNew", "\x00,"] and aligner.parts("don't") == ["don't"]
    docs = spark.createDataFrame(MARKED, "doc_id bigint, text string").coalesce(1)
    got = [(*r[:7], hashlib.sha256(r[7].encode()).hexdigest() if r[7] else "") for r in ta.align(docs).collect()]
    assert ordered(got) == ordered(brute(MARKED))
    # Words that differ in the marks behind them only share their parts in a chunk.
    words = [f"word{chr(97 + i)}{mark}" for i in range(20) for mark in ("", ",", ".", "!", "?", ";")]
    chunk = ta._chunks(spark.createDataFrame([(1, " ".join(words))], "doc_id bigint, text string").coalesce(1),
                       f"{ta.TOKENIZERS}/{ta.FILE_A}", f"{ta.TOKENIZERS}/{ta.FILE_B}", ta.CHUNK_UNITS).first()
    assert len(chunk["n_a"]) == 25


def test_chunks_cross_as_small_rows(spark):
    # 32,000 different words in one chunk: none of its rows is as large as the chunk, and pieces in any order give the documents.
    rng = np.random.default_rng(5)
    rows = [(i, " ".join("".join(w) for w in rng.choice(list("abcdefghijklmnopqrstuvwxyz"), (4000, 7)))) for i in range(8)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1)
    chunks = ta._chunks(docs, f"{ta.TOKENIZERS}/{ta.FILE_A}", f"{ta.TOKENIZERS}/{ta.FILE_B}", ta.CHUNK_UNITS).collect()
    size = lambda row: sum(len(v) * (1 if isinstance(v, (bytes, bytearray)) else 8) for v in row if hasattr(v, "__len__"))
    assert len({r["chunk"] for r in chunks}) == 1 and len(chunks) > 1
    assert max(map(size, chunks)) < 1 << 18 < sum(map(size, chunks))
    got = [(*r[:7], hashlib.sha256(r[7].encode()).hexdigest()) for r in ta.align(docs).collect()]
    assert ordered(got) == ordered(brute(rows))


@pytest.mark.parametrize("top", [0, 1, 256, 257, 1 << 16, (1 << 16) + 1, (1 << 24) + 1])
def test_numbers_cross_as_byte_planes(top):
    x = np.array([top - 1, 0, top // 2, top - 1] if top else [], np.uint32)
    planes = ta._planes(x, top)
    assert len(planes) == len(x) * max(1, -(-(top - 1).bit_length() // 8)) and ta._numbers(planes, len(x)).tolist() == x.tolist()


def test_byte_ends_between_coarse_cuts():
    # A unit of one character of three bytes over three tokens and two of one byte, then one of a single token.
    size, at, first = np.array([1, 2, 3]), np.array([0, 3, 4, 5, 8]), np.array([0, 3, 4])
    _, ends = ta._ends([[0, 0, 0, 1], [2]], [[(0, 1), (0, 1), (0, 1), (1, 3)], [(0, 1)]], size, at, first, 0)
    assert ends.tolist() == [1, 2, 3, 5, 8]
    with pytest.raises(ValueError):
        ta._ends([[2]], [[(0, 1)]], size, np.array([0, 1, 2]), np.array([0, 1]), 0)
