import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from loadsieve.llm import QUERIES
from loadsieve.llm.alignment import aligned, terminals, with_groups


@pytest.fixture(scope="module")
def sides():
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def ends_of(lengths):
    return list(np.cumsum(lengths)) if lengths else []


def brute_tokens(sides, text):
    """Ids and byte ranges of the whole text, or nothing where the bytes don't come back."""
    if not text:
        return [], []
    a, b = sides
    raw = (" " + text).encode()
    encoded = a.encode(" " + text, add_special_tokens=False)
    # offsets are of characters; byte lengths follow from the byte-level strings of the tokens
    a_tokens, b_tokens = list(zip(encoded.ids, map(len, encoded.tokens))), []
    found = b""
    for i in b.encode(text):
        piece = b.id_to_piece(i)
        own = bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()
        found += own
        b_tokens.append((i, len(own)))
    if found != raw or sum(n for _, n in a_tokens) != len(raw):
        return [], []
    out = []
    for tokens in (a_tokens, b_tokens):
        at, spans = 0, []
        for i, n in tokens:
            spans.append((i, at, at + n))
            at += n
        out.append(spans)
    return tuple(out)


def brute_groups(a, b):
    groups, i, j = [], 0, 0
    while i < len(a):
        x, y = [a[i]], [b[j]]
        i, j = i + 1, j + 1
        while x[-1][2] != y[-1][2]:
            if x[-1][2] < y[-1][2]:
                x.append(a[i])
                i += 1
            else:
                y.append(b[j])
                j += 1
        groups.append(([t[0] for t in x], [t[0] for t in y]))
    return groups


def brute(sides, rows):
    tokens = [brute_tokens(sides, t) for _, t in rows]
    links = []
    for a, b in tokens:
        own, at = [], 0
        for i, s, e in a:
            while at < len(b) and b[at][2] <= s:
                at += 1
            k = at
            while k < len(b) and b[k][1] < e:
                own.append((i, b[k][0]))
                k += 1
        links.append(own)
    counts = Counter(p for own in links for p in own)
    highest = {}
    for (_, b), n in counts.items():
        highest[b] = max(n, highest.get(b, 0))
    found = []
    for (d, _), (a, b), own in zip(rows, tokens, links):
        groups = brute_groups(a, b)
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        digest = hashlib.sha256(text.encode()).hexdigest() if a else ""
        best = sum(counts[p] == highest[p[1]] for p in own)
        found.append((d, len(a), len(b), len(groups), len(own), best, sum(counts[p] for p in own), digest))
    return found


def by_value(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: tuple((v is not None, v) for v in r))


def test_query_against_brute_force(spark, sf_dir, docs, sides):
    got = QUERIES["op13_token_alignment"](spark, sf_dir)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert [t for _, t in got.dtypes] == ["bigint"] * 7 + ["string"]
    assert by_value(got.collect()) == by_value(brute(sides, [(r.doc_id, r.text) for r in docs.collect()]))


def test_edges_against_brute_force(spark, edge, nothing, sides):
    more = [" ", "  ", "a  b", " lead", "trail ", "tab\t x", "a  b　 c \x1c d \x85 e", "under ▁ stand-in", "x▁", "<s> </s> <unk> <0x41>", "<|endoftext|> <|endoftext|>"]
    more += ["\x00\x01", "naïve ﬁne ½ 𝄞 👩‍👩‍👧 שלום", "don't we'll I'M", "nospace" * 3000, "\r\n\r\n  x\n y", "١٢٣ 4567 8.90"]
    docs = edge.select("doc_id", "text", "kept").unionByName(spark.createDataFrame([(100 + i, t, "") for i, t in enumerate(more)], "doc_id long, text string, kept string"))
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = by_value(brute(sides, rows))
    for chars in (8_000_000, 40):  # one chunk a task, and one chunk for almost every document
        assert by_value(aligned(docs, chars).collect()) == want
    assert {r[0]: r[1] for r in want}[107] == 0 and {r[0]: r[7] for r in want}[108] == ""
    assert aligned(nothing).count() == 0


def test_random_texts_run_by_run(spark, sides):
    draw = random.Random(5)
    letters = "ab'sé \n\t  ▁0.,x<|> \x1c字🙂R"
    rows = [(i, "".join(draw.choice(letters.replace("▁", "") if i % 4 else letters) for _ in range(draw.randint(0, 40)))) for i in range(3000)]
    got = aligned(spark.createDataFrame(rows, "doc_id long, text string"))
    assert by_value(got.collect()) == by_value(brute(sides, rows))


def test_groups_are_whole_outputs(spark, edge, sides):
    clashing = edge.withColumn("groups", F.lit("mine")).withColumn("whole", F.lit(1)).withColumn("runs", F.lit(2))
    got = with_groups(clashing)
    assert got.columns == [c for c in clashing.columns if c != "groups"] + ["groups"]
    for r in got.collect():
        assert [(g.a, g.b) for g in r.groups] == brute_groups(*brute_tokens(sides, r.text))


def test_pointers_against_components():
    draw = np.random.default_rng(3)
    for _ in range(300):
        n = int(draw.integers(1, 60))
        a, b = (np.unique(np.r_[draw.integers(1, n + 1, draw.integers(1, 20)), n]) for _ in range(2))
        common = np.intersect1d(a, b)
        last_a, last_b = terminals(a, b)
        assert (b[last_a] == common[np.searchsorted(common, a)]).all() and (b[last_b] == common[np.searchsorted(common, b)]).all()
