"""Cross-tokenizer alignment against brute force."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from notecohort.llm import align, common, queries

A = queries.vocabulary("byte_bpe_50k.json")
B = align.read_model(public_tokenizers.path("piece_bpe_32k.model"))
LIBRARY_A = Tokenizer.from_str(A)
LIBRARY_A.encode_special_tokens = True
LIBRARY_B = SentencePieceProcessor(model_proto=B)


def a_bytes(text):
    """Ids of A with their bytes, from the library's own decoder of single ids and its offsets."""
    ids = LIBRARY_A.encode(text, add_special_tokens=False).ids
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    of = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in shown)}
    return ids, [bytes(of[c] for c in LIBRARY_A.id_to_token(i)) for i in ids]


def b_bytes(text):
    ids = LIBRARY_B.encode(text)
    return ids, [bytes([int(LIBRARY_B.id_to_piece(i)[3:5], 16)]) if LIBRARY_B.is_byte(i) else LIBRARY_B.id_to_piece(i).replace("▁", " ").encode()
                 for i in ids]


def spans(pieces):
    at, out = 0, []
    for p in pieces:
        out.append((at, at + len(p)))
        at += len(p)
    return out


def brute(rows):
    parts, count = [], Counter()
    for d, t in rows:
        (a, xa), (b, xb) = (a_bytes(" " + t), b_bytes(t)) if t else (([], []), ([], []))
        if not t or b"".join(xa) != b" " + t.encode() or b"".join(xb) != b" " + t.encode():
            parts.append((d, 0, 0, 0, [], ""))
            continue
        sa, sb, links, j = spans(xa), spans(xb), [], 0
        for i, (lo, hi) in enumerate(sa):
            while sb[j][1] <= lo:
                j += 1
            k = j
            while k < len(sb) and sb[k][0] < hi:
                links.append((a[i], b[k]))
                k += 1
        groups, i, j = [], 0, 0
        for end in sorted({e for _, e in sa} & {e for _, e in sb}):
            left, right = [], []
            while i < len(a) and sa[i][1] <= end:
                left.append(str(a[i]))
                i += 1
            while j < len(b) and sb[j][1] <= end:
                right.append(str(b[j]))
                j += 1
            groups.append(",".join(left) + "|" + ",".join(right))
        count.update(links)
        parts.append((d, len(a), len(b), len(groups), links, ";".join(groups)))
    most = defaultdict(int)
    for (_, b), n in count.items():
        most[b] = max(most[b], n)
    return Counter((d, na, nb, ng, len(links), sum(count[x] == most[x[1]] for x in links), sum(count[x] for x in links), g)
                   for d, na, nb, ng, links, g in parts)


def given(df):
    return [(r.doc_id, r.text) for r in df.collect()]


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    want = Counter()
    for (*row, groups), n in brute(given(spark.read.parquet(f"{sf}/documents.parquet"))).items():
        want[(*row, hashlib.sha256(groups.encode()).hexdigest() if row[1] else "")] += n
    got = queries.op12_anchor_alignment(spark, sf)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert Counter(map(tuple, got.collect())) == want


@pytest.mark.parametrize("broadcast_pairs", [align.BROADCAST_PAIRS, 0])
def test_odd_rows(odd, none, broadcast_pairs):
    """Both ways to bring the counts to the texts."""
    assert Counter(map(tuple, align.align(odd, A, B, broadcast_pairs).collect())) == brute(given(odd))
    assert align.align(none, A, B, broadcast_pairs).collect() == []


@pytest.mark.parametrize("broadcast_pairs", [align.BROADCAST_PAIRS, 0])
def test_hard_texts(spark, broadcast_pairs):
    """White space of all kinds, special tokens as text, what B changes, bytes beyond its pieces."""
    rnd = random.Random(2)
    texts = [" ", "a  b", "a   b \n c\n\n d  \ne", " lead", "  two", "trail ", "trail  ", "\n", "  \n", "\n ", "A\r\nB\r\n  C", "tab\tx 　 y   z",
             "<|endoftext|> <s> <unk> </s> <0x41>", "a▁b", "▁", "漢字 é \x00 \x1c x y", "don't I'll we've  's", "\U0001F600\U0001F601 ok", "a \x85 b   c",
             "\x1c \n x", "x" * 3000]
    texts += ["".join(rnd.choice([" ", "  ", "\n", "a", "the", "é", "'s", "1", "\t", "。", "\x1d", "ing"]) for _ in range(rnd.randint(1, 60))) for _ in range(300)]
    rows = [(i if i % 7 else None, t) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert Counter(map(tuple, align.align(docs, A, B, broadcast_pairs).collect())) == brute(rows)


@pytest.mark.parametrize("broadcast_pairs", [align.BROADCAST_PAIRS, 0])
def test_no_sound_text(spark, broadcast_pairs):
    docs = spark.createDataFrame([(1, None), (2, ""), (3, "a▁b")], "doc_id long, text string")
    assert sorted(map(tuple, align.align(docs, A, B, broadcast_pairs).collect())) == [(i, 0, 0, 0, 0, 0, 0, "") for i in (1, 2, 3)]


def test_windows_begin_at_shared_space_marks():
    both = align.tokenizers(A, B)
    assert both.a.short is not None
    pa, pb = both.a.pieces, both.b.pieces
    for t in ("the quick brown foxes jump", "antidisestablish mentarian's 12345 words", "x" * 50):
        a, b = both.a.encode(t), both.b.encode(t)
        at_a, at_b = align.cut(a, b, pa, pb)
        assert at_a[0] == at_b[0] == 0 and len(at_a) == len(t.split())
        for i, j in zip(at_a, at_b, strict=True):
            assert pa.joined(a[i:])[:1] == pb.joined(b[j:])[:1] == b" " and pa.joined(a[:i]) == pb.joined(b[:j])


def test_ids_are_those_of_the_library(spark):
    """Both ways of A, on texts of all kinds of characters."""
    both, rnd = align.tokenizers(A, B), random.Random(9)
    texts = [t for _, t in given(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))]
    stable = [chr(c) for c in [*range(0x250), *range(0x2010, 0x2028), *range(0x2030, 0x205F)]]
    texts += ["".join(rnd.choice(stable + [" ", " ", "a", "'s", "1"]) for _ in range(rnd.randint(1, 80))) for _ in range(3000)]
    assert all(align._STABLE(t) for t in texts[-3000:])
    texts += ["".join(stable), "漢字 \u0378 \U0001F600 x", "x" * 200_000, "ab " * 50_000 + "\u0301"]
    for t in texts:
        assert both.a.encode(t).tolist() == a_bytes(" " + t)[0] and both.b.encode(t).tolist() == LIBRARY_B.encode(t)


def test_distinct_windows():
    rng = np.random.default_rng(3)
    windows = [(tuple(rng.integers(0, 3, rng.integers(1, 4))), tuple(rng.integers(0, 3, rng.integers(1, 4)))) for _ in range(2000)]
    a, b = (np.concatenate([np.array(w[k], np.uint32) for w in windows]) for k in (0, 1))
    at_a, at_b = (np.cumsum([0] + [len(w[k]) for w in windows])[:-1] for k in (0, 1))
    first, which = align.distinct_windows(a, at_a, b, at_b)
    assert len(first) == len(set(windows)) and [windows[first[k]] for k in which] == windows
    none = np.zeros(0, np.int64)
    assert [len(x) for x in align.distinct_windows(none, none, none, none)] == [0, 0]


def test_blocks_are_written_in_small_row_groups(spark, monkeypatch):
    """Readers and codecs hold whole pages and row groups: sixty rows of 200 KB are not one of 12 MB."""
    options = {}

    def saved(df, name, *how):
        options[name] = how
        return common.saved(df, name, *how)

    monkeypatch.setattr(align, "saved", saved)
    align.align(spark.createDataFrame([(1, "some words")], "doc_id long, text string"), A, B).collect()
    rows = spark.range(60).repartition(1).select(F.expr(
        "unhex(array_join(transform(sequence(1, 3200), i -> sha2(cast(id * 3200 + i as string), 512)), ''))").alias("block"))
    kept = common.saved(rows, "wide-rows", *options["token-windows"])
    files = [pq.ParquetFile(f.removeprefix("file://").removeprefix("file:")).metadata for f in kept.inputFiles()]
    sizes = [m.row_group(i).total_byte_size for m in files for i in range(m.num_row_groups)]
    assert kept.count() == 60 and sum(sizes) > 10 << 20 and max(sizes) < 9 << 20
