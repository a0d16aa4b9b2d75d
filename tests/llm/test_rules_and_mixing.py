import re
from collections import Counter, defaultdict

import duckdb
import oracle
import pytest
from corpus_fixtures import write_tables

from palate.llm import mixing, quality_rules
from palate.session import settle

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def measured(text):
    words = WORD.findall(text or "")
    grams = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = {i + k for i in range(len(words) - 4) if grams[tuple(words[i : i + 5])] > 1 for k in range(5)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines),
        len(lines) - len(set(lines)), len(covered),
    )


def test_measures_equal_brute_force(odd):
    rows = quality_rules.measure(odd).collect()
    assert len(rows) == odd.count()
    for r in rows:
        got = (r.n_words, r.word_chars, r.n_symbols, r.n_lines, r.n_dup_lines, r.n_repeat_words)
        assert got == measured(r.text)
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)


def test_overlapping_repeats(spark):
    texts = ["a a a a a a a", "a b c d e f a b c d e", "a b c d e", "a b c d e a b c d e a b c d", "x " * 4]
    df = spark.createDataFrame([(i, t, "en", "s") for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string")
    got = {r.doc_id: r.n_repeat_words for r in quality_rules.measure(df).collect()}
    assert got == {i: measured(t)[5] for i, t in enumerate(texts)}


def test_filters_over_measures_do_not_blow_up(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(1, "en", "s", " ".join(f"w{i}" for i in range(30_000)))], "doc_id long, lang string, source string, text string")
    assert quality_rules.measure(df).where("NOT base_failed AND n_repeat_words = 0").where(F.col("n_words") > 5).count() == 1


def test_fences_follow_their_group(spark):
    rows = []
    for s, length in (("short", 4), ("long", 12)):
        for i in range(40):
            rows.append((len(rows), "en", s, " ".join(("w" * length + str(i * 31 + k))[-length:] for k in range(30))))
    odd_one = (999, "en", "short", " ".join("y" * 11 + str(k % 10) for k in range(30)))
    other = (1000, "en", "long", " ".join("y" * 10 + str(k).zfill(2) for k in range(30)))
    df = spark.createDataFrame([*rows, odd_one, other], "doc_id long, lang string, source string, text string")
    kept = {r.doc_id for r in quality_rules.judge(df).where("kept").collect()}
    assert 999 not in kept and 1000 in kept and kept >= {r[0] for r in rows}


def plain(i, source, lang="en", mark="", length=5):
    words = [("w" * length + str(i * 31 + k))[-length:] for k in range(30)]
    return (i, lang, source, " ".join(w + mark for w in words))


DOCS = "doc_id long, lang string, source string, text string"


def test_wider_fences_close_small_and_spoiled_groups(spark):
    good = [plain(i, s) for s, at in (("a", 0), ("b", 100), (None, 200)) for i in range(at, at + 60)]
    spoiled = [plain(i, "spoiled", mark="##" * (i % 5 < 2)) for i in range(300, 350)]  # 40 % junk
    small = [plain(400, "small"), plain(401, "small"), plain(402, "small", mark="##")]
    only = [plain(410, "small", None, mark="##")]  # no language, one document
    df = spark.createDataFrame([*good, *spoiled, *small, *only], DOCS)
    kept = {r.doc_id for r in quality_rules.judge(df).where("kept").collect()}
    assert kept == {r[0] for r in [*good, *spoiled, *small, *only] if "##" not in r[3]}
    assert {r.doc_id for r in quality_rules.keep_good(df).collect()} == kept


def test_the_registered_query_knows_the_wider_fences(spark, tmp_path):
    """Through the query and its SQL: a group with 40 % junk, and one of three documents."""
    good = [plain(i, s) for s, at in (("a", 0), ("b", 100)) for i in range(at, at + 60)]
    spoiled = [plain(i, "spoiled", mark="##" * (i % 5 < 2)) for i in range(300, 350)]
    small = [plain(400, "small"), plain(401, "small"), plain(402, "small", mark="##")]
    folder = write_tables(spark, tmp_path, documents=spark.createDataFrame([*good, *spoiled, *small], DOCS))
    got = quality_rules.op6_quality_rules(spark, folder)
    assert {r.doc_id for r in got.where("kept").collect()} == {r[0] for r in [*good, *spoiled, *small] if "##" not in r[3]}
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{folder}/documents.parquet/*.parquet')")
    rows, problems = oracle.compare(got, duck, quality_rules.OP6_SQL)
    assert rows and not problems


def test_wider_fences_spare_other_kinds_of_text(spark):
    """A source full of symbols and a language of long words stay, whatever the rest looks like."""
    rest = [plain(i, s) for s, at in (("a", 0), ("b", 200)) for i in range(at, at + 120)]
    code = [plain(i, "code", mark="<>") for i in range(400, 430)]
    long = [plain(i, s, "xx", length=40) for s, at in (("a", 500), ("b", 530)) for i in range(at, at + 25)]
    few = [plain(i, "c", "xx", length=40) for i in range(600, 603)]
    df = spark.createDataFrame([*rest, *code, *long, *few], DOCS)
    assert quality_rules.judge(df).where("kept").count() == df.count()


def test_keep_good_returns_the_columns_and_agrees_with_judge(odd):
    kept = quality_rules.keep_good(odd)
    assert kept.columns == odd.columns
    assert kept.count() == quality_rules.judge(odd).where("kept").count()
    assert all(r.doc_id not in (4, 5, 6) for r in kept.collect())


def test_clashing_measure_names(odd):
    docs = odd.withColumnRenamed("n_chars", "n_words").withColumnRenamed("size", "base_failed")
    got = quality_rules.keep_good(docs)
    assert got.columns == docs.columns
    assert {r.base_failed for r in got.collect()} <= {"x", None, ""}


def test_empty_table(none):
    assert quality_rules.judge(none).count() == 0
    assert quality_rules.keep_good(none).count() == 0
    assert mixing.mix(none).count() == 0


def brute_mix(rows, weights=(5, 2, 1), share=1.5, passes=2):
    """``rows``: (doc_id, source, size).  Level by bisection, then the sorted line."""
    import hashlib

    size = defaultdict(int)
    for _, s, n in rows:
        size[s] += n
    order = sorted(size, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    budget = int(share * sum(size.values()))
    lo, hi = 0.0, 4.0 * sum(size.values()) + 1
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if sum(min(w[s] * mid, passes * size[s]) for s in size) < budget else (lo, mid)
    targets = {s: min(w[s] * hi, passes * size[s]) for s in size}
    line, run = [], defaultdict(int)
    h = lambda d: hashlib.md5(str("" if d is None else d).encode()).hexdigest()
    for d, s, n in sorted(rows, key=lambda r: (h(r[0]), r[0] is not None, r[0] or 0, r[2])):
        run[s] += n
        line += [((p * size[s] + run[s]) / w[s], s is None, (s or "").encode(), p * size[s] + run[s], h(d), d, n) for p in range(passes) if n]
    taken, total = Counter(), 0
    for x in sorted(line, key=lambda x: x[:5]):
        if total + x[-1] > budget:
            break
        total += x[-1]
        taken[x[5]] += x[-1]
    return targets, taken


@pytest.mark.parametrize("seed", range(4))
def test_mixing_equals_brute_force(spark, seed):
    import random

    r = random.Random(seed)
    rows = [(i, r.choice(["hot"] * 5 + ["a", "b", None, "", "é", "zz"]), r.choice([0, 1, 5, 50, 700])) for i in range(r.choice([1, 30, 400]))]
    df = spark.createDataFrame(rows, "doc_id long, source string, size long")
    got = mixing.queue(df).collect()
    targets, taken = brute_mix(rows)
    assert len(got) == len(rows)
    for x in got:
        assert x.target == pytest.approx(targets[x.source], rel=1e-6, abs=1e-5)
        assert x.passes * x.size == taken[x.doc_id]


@pytest.mark.parametrize("seed", range(3))
def test_mixing_with_crowded_ids_equals_brute_force(spark, monkeypatch, seed):
    """Most rows have no id or one id; they are counted off in parts."""
    import random

    monkeypatch.setattr(mixing, "GRAIN", 10)
    monkeypatch.setattr(mixing, "LOTS", 20)
    r = random.Random(seed)
    rows = [(r.choice([None, None, 7, i]), r.choice(["hot"] * 3 + ["a", None]), r.choice([0, 1, 5, 50])) for i in range(500)]
    df = spark.createDataFrame(rows, "doc_id long, source string, size long").repartition(4)
    sized = settle(df, "test")
    crowded = mixing.crowded_ids(sized, 500)
    assert {x.doc_id for x in crowded.collect()} == {None, 7}
    got = mixing.queue(sized).collect()
    targets, taken = brute_mix(rows)
    mine = Counter()
    for x in got:
        assert x.target == pytest.approx(targets[x.source], rel=1e-6, abs=1e-5) and 0 <= x.passes <= 2
        mine[x.doc_id] += x.passes * x.size
    assert len(got) == 500 and +mine == +taken


def test_sums_before_in_two_levels(spark, monkeypatch):
    import random

    monkeypatch.setattr(mixing, "GRAIN", 4)
    r = random.Random(1)
    rows = [(g, at, r.randint(0, 9)) for g in ("a", None) for at in r.sample(range(200), 60)]
    df = spark.createDataFrame(rows, "g string, at long, v long")
    got = {(x.g, x.at): x.out for x in mixing.before(df, ["g"], "at", "v", "out").collect()}
    assert got == {(g, at): sum(v for h, b, v in rows if h == g and b < at) for g, at, _ in rows}
    alone = df.where("g = 'a'").drop("g")
    assert {x.at: x.out for x in mixing.before(alone, [], "at", "v", "out").collect()} == {at: n for (g, at), n in got.items() if g == "a"}


def test_mixing_takes_near_the_targets_and_reruns_agree(spark):
    rows = [(i, "hot" if i % 3 == 0 else f"s{i % 7}", 1 + i * 37 % 100) for i in range(6000)]
    df = spark.createDataFrame(rows, "doc_id long, source string, size long")
    a, b = (sorted(map(tuple, mixing.queue(x).collect())) for x in (df, df.repartition(5)))
    assert a == b
    given = defaultdict(int)
    for _, s, size, source_size, target, passes in a:
        given[s, target] += size * passes
        assert passes <= 2
    assert all(abs(n - t) <= 200 for (_, t), n in given.items())


def test_mix_repeats_whole_rows(odd):
    got = mixing.mix(odd)
    assert got.columns == odd.columns
    rows = got.collect()
    assert rows and all(WORD.search(r.text or "") for r in rows)
    once = Counter(map(str, odd.collect()))
    assert all(n <= 2 * once[r] for r, n in Counter(map(str, rows)).items())
