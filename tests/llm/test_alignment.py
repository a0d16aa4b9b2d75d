import hashlib
import random
from collections import Counter

import pytest
import sentencepiece
from corpus_fixtures import prose
from tokenizers import Tokenizer

from palate.llm import alignment

A, B = alignment.vocabularies()
BITS = ["a", "The", "tion", " ", " ", "  ", "   ", "\n", "\t", "é", "日本", "語", "x" * 30, "42", "'s", "'re", "-", "\x00", "Über", "　", "\xa0", "\x85",
        "\x1c", "᠎", "​", "<|endoftext|>", "<s>", "<0x41>", "ﬁ", "😀", "é", ".", ",", "!!", "▁", "\r\n", " "]


@pytest.fixture(scope="module")
def libraries():
    t = Tokenizer.from_file(A)
    t.encode_special_tokens = True
    return t, sentencepiece.SentencePieceProcessor(model_file=B)


def plain(libraries, text):
    """Ids of both sides, their bytes and the groups of a whole text, without cutting or dictionaries."""
    t, sp = libraries
    letters = alignment.byte_letters()
    ids_a = t.encode(" " + text, add_special_tokens=False).ids if text else []
    ids_b = sp.encode(text) if text else []
    bytes_a = [bytes(letters[c] for c in t.id_to_token(i)) for i in ids_a]
    bytes_b = [bytes([int(p[3:5], 16)]) if sp.is_byte(i) else p.replace("▁", " ").encode() for i, p in ((i, sp.id_to_piece(i)) for i in ids_b)]
    if not text or not b"".join(bytes_a) == b"".join(bytes_b) == (" " + text).encode():
        return None
    groups, i, j, at_a, at_b, ga, gb = [], 0, 0, 0, 0, [], []
    while i < len(ids_a) or j < len(ids_b):
        if at_a <= at_b and i < len(ids_a):
            at_a += len(bytes_a[i])
            ga.append(ids_a[i])
            i += 1
        else:
            at_b += len(bytes_b[j])
            gb.append(ids_b[j])
            j += 1
        if at_a == at_b:
            groups.append((ga, gb))
            ga, gb = [], []
    return len(ids_a), len(ids_b), groups


def brute(libraries, docs):
    found = [(i, plain(libraries, t or "")) for i, t in docs]
    counts = Counter((g[0][-1], g[1][-1]) for _, x in found if x for g in x[2])
    most = {}
    for (_, b), n in counts.items():
        most[b] = max(most.get(b, 0), n)
    rows = []
    for i, x in found:
        if x is None:
            rows.append((i, 0, 0, 0, 0, 0, 0, ""))
            continue
        links = [(g[0][-1], g[1][-1]) for g in x[2]]
        shown = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in x[2])
        rows.append((i, x[0], x[1], len(x[2]), len(links), sum(counts[p] == most[p[1]] for p in links), sum(counts[p] for p in links), hashlib.sha256(shown.encode()).hexdigest()))
    return sorted(rows, key=str)


def got(df):
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"]
    return sorted((tuple(r) for r in df.select(names).collect()), key=str)


@pytest.mark.parametrize("seed", range(6))
def test_cut_texts_equal_whole_texts(libraries, seed):
    r = random.Random(seed)
    both = alignment.Pair(A, B, groups=True)
    assert both.cuts
    for k in range(150):
        bits = [BITS, BITS[:12], ["a", "B.", " ", "\n", "\n", "x\ny", "é", " \n"]][k % 3]
        texts = ["".join(r.choice(bits) for _ in range(r.randint(0, 60))) for _ in range(4)]
        facts, shown, pairs, times = both.documents(texts)
        for i, t in enumerate(texts):
            want = plain(libraries, t)
            if want is None:
                assert not facts[i].any() and shown[i] == "" and not len(pairs[i])
                continue
            assert facts[i].tolist() == [want[0], want[1], len(want[2]), len(want[2])]
            assert shown[i] == ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in want[2])
            links = Counter(a[-1] * 32000 + b[-1] for a, b in want[2])
            assert dict(zip(pairs[i].tolist(), times[i].tolist(), strict=True)) == links


def test_without_cuts(libraries):
    both = alignment.Pair(A, B, groups=True)
    both.cuts = False
    facts, *_ = both.documents([prose(1, 100)])
    assert facts[0, 0] == plain(libraries, prose(1, 100))[0]


def test_corpus_equals_brute_force(spark, libraries, monkeypatch):
    monkeypatch.setattr(alignment, "PAIRS_AT_ONCE", 100)
    r = random.Random(9)
    docs = [(i, "".join(r.choice(BITS[:30]) for _ in range(r.randint(0, 80)))) for i in range(200)]
    docs += [(1000 + i, prose(i % 9, 50)) for i in range(60)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    assert got(alignment.align(df, A, B)) == brute(libraries, docs)


def test_a_forgetful_table_changes_nothing(libraries, monkeypatch):
    monkeypatch.setattr(alignment, "REMEMBERED", 3)
    both = alignment.Pair(A, B, groups=True)
    for k in range(5):
        facts, *_ = both.documents([prose(k, 40), prose(k + 1, 30)])
        assert facts[:, 0].tolist() == [plain(libraries, t)[0] for t in (prose(k, 40), prose(k + 1, 30))]


def test_odd_rows(spark, odd, libraries):
    clashing = odd.withColumnsRenamed({"kept": "pairs", "size": "groups", "fp": "total", "n_chars": "n_a"})
    assert got(alignment.align(clashing, A, B)) == brute(libraries, [(r.doc_id, r.text) for r in odd.collect()])


def test_empty(none):
    assert alignment.align(none, A, B).collect() == []


def test_pairs_are_bounded_by_the_bytes_of_the_vocabularies():
    both = alignment.Pair(A, B)
    spelled_a = {}
    for x in both.bytes_a:
        spelled_a[x] = spelled_a.get(x, 0) + 1
    spelled_b = {}
    for x in both.bytes_b:
        spelled_b[x] = spelled_b.get(x, 0) + 1
    longer_a = sum(spelled_b.get(x[k:], 0) for x in both.bytes_a for k in range(len(x)))
    longer_b = sum(spelled_a.get(x[k:], 0) for x in both.bytes_b for k in range(1, len(x)))
    assert longer_a + longer_b < 2 * (sum(map(len, both.bytes_a)) + sum(map(len, both.bytes_b))) < 2_000_000
