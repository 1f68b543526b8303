"""The llm operators against brute force, and on nulls, empty texts, ties and empty tables."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter, defaultdict
from functools import reduce

import public_tokenizers
import pytest
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from riskflow.llm import common, decontamination, fingerprints, language_model, line_dedup, mixing
from riskflow.llm import ngram_join, quality, suffix_dedup, token_counts, toxicity

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, k1 string"
LABELS = "doc_id long, quality int, toxic int"


def lower(text: str) -> str:
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def words(text: str) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", lower(text))


def texts() -> list[tuple[int | None, str | None]]:
    rng = random.Random(3)
    lexicon = ["alpha", "beta", "gamma", "delta", "the", "of", "Ünit", "zeta's", "x1", "kappa,", "mu."]
    make = lambda n: " ".join(rng.choice(lexicon) + rng.choice(["", "", "s"]) for _ in range(n))
    base, line = make(300), make(12)
    out = [base, base, base.replace("alpha", "omega", 3), base + " one more end", line + "\n" + make(40), make(20) + "\n" + line]
    out += [make(60) + "\n" + line.replace("the", "The") + "\n" + make(9), "", None, "a", "Two words", " \n\t ", make(5), make(5)]
    out += [make(rng.randint(1, 80)) for _ in range(16)] + [base[:900] + make(30), make(30) + base[200:1200], "x" * 1500]
    return [(i, t) for i, t in enumerate(out)] + [(None, base)]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, ["en", "de", None][(i or 0) % 3], "s", len(t or ""), 1.0, "k") for i, t in texts()]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(i, int(i % 4 > 0), int(i % 5 == 0)) for i in range(30)] + [(None, 1, 1), (3, None, None)], LABELS)


def by_id(df) -> dict:
    return {r.doc_id: r for r in df.collect() if r.doc_id is not None}


def known() -> dict[int, str]:
    return {i: t or "" for i, t in texts() if i is not None}


@pytest.mark.parametrize(("width", "percent"), [(3, 90), (5, 80)])
def test_ngram_join(docs, width, percent):
    sets = {}
    for i, t in known().items():
        w = words(t)
        sets[i] = frozenset(tuple(w[k : k + width]) for k in range(max(1, len(w) - width + 1))) if w else frozenset()
    root = {i: i for i in sets}
    for _ in sets:
        for a in sets:
            for b in sets:
                common_n = len(sets[a] & sets[b])
                if common_n and 100 * common_n >= percent * len(sets[a] | sets[b]):
                    root[a] = min(root[a], root[b])
    got = by_id(ngram_join.link_components(docs, width, percent))
    assert {i: (r.n_shingles, r.component_id) for i, r in got.items()} == {i: (len(sets[i]), root[i]) for i in sets}


def test_keep_one(docs):
    kept = ngram_join.keep_one(docs, 5, 80)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert 1 not in ids and {0, 7, 8, None} <= set(ids)


@pytest.mark.parametrize("block_bytes", [1 << 20, 40])
def test_decontamination(spark, docs, block_bytes):
    source = known()
    items = [(1, source[0][100:300]), (2, "two WORDS"), (3, ""), (4, None), (5, "not there at all"), (None, source[4][:120])]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    cut = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t))
    got = by_id(decontamination.hit_report(docs, benchmark, block_bytes=block_bytes))
    for i, t in source.items():
        w, hit, owners = cut(t), set(), set()
        for item, text in items:
            v = cut(text)
            for k in range(max(1, len(v) - 9)) if v else []:
                window = v[k : k + 10]
                for at in range(len(w) - len(window) + 1):
                    if w[at : at + len(window)] == window:
                        hit.update(range(at, at + len(window)))
                        owners.add("" if item is None else str(item))
        assert (got[i].n_words, got[i].n_hit, got[i].item_ids) == (len(w), len(hit), sorted(owners))
    kept = decontamination.drop_contaminated(docs, benchmark)
    assert kept.columns == docs.columns and 8 in [r.doc_id for r in kept.collect()]


def test_prefix_counts_equal_the_library():
    path = public_tokenizers.path("byte_bpe_50k.json")
    prefixes, library = token_counts.counter(path), Tokenizer.from_file(path)
    rng = random.Random(5)
    alphabet = [*"ab'srevldtm  \n\t!?.,19", "é", "ß", "世", "\xa0", "\x1c", "\x85", "😀", "<|endoftext|>", "'re", "----"]
    for _ in range(400):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 20)))
        table, total = prefixes.table(text)
        steps = [b - 256 if b > 127 else b for b in table]
        counts = [len(library.encode(text[: i + 1], add_special_tokens=False).ids) for i in range(len(text))]
        assert [sum(steps[: i + 1]) for i in range(len(text))] == counts and total == (counts[-1] if counts else 0)


def test_new_words_cost_no_plain_encoding(monkeypatch):
    """Whether tokens may be neighbours is read off their merges, and equals the plain encoding."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    prefixes, library, rng = token_counts.PrefixCounter(path), Tokenizer.from_file(path), random.Random(6)
    tokens = sorted(prefixes.tokens, key=lambda t: (len(t), t))
    pairs = [(rng.choice(some), rng.choice(some)) for some in (tokens[:2000], tokens) for _ in range(2000)]
    pairs += [(b"a" * i, b"a" * j) for i in (1, 2, 4) for j in (1, 2, 4)]
    pairs = [(a, b) for a, b in pairs if a in prefixes.tokens and b in prefixes.tokens]
    plain = [prefixes.merged(a + b) == [a, b] for a, b in pairs]
    monkeypatch.setattr(prefixes, "merged", None)
    assert [prefixes.may_follow(a, b) for a, b in pairs] == plain and 0 < sum(plain) < len(plain)
    # Words that begin alike, longer and shorter than the beginnings whose state is kept.
    for _ in range(300):
        text = "".join(rng.choice((" inontion", " inonti", " théast", "zu")) + rng.choice("aeréß.") for _ in range(8))
        assert prefixes.table(text)[1] == len(library.encode(text, add_special_tokens=False).ids)


def test_count_tokens(docs):
    got = by_id(token_counts.count_tokens(docs, public_tokenizers.path("byte_bpe_50k.json"), 100))
    assert got[8].n_tokens == 0 and got[7].n_bytes == 0 and got[0].over_limit and not got[9].over_limit


def test_longest_prefix_without_tables(spark, monkeypatch):
    """Counts and the longest prefix equal those of the table, which only special strings need."""
    path, rng = public_tokenizers.path("byte_bpe_50k.json"), random.Random(8)
    prefixes = token_counts.PrefixCounter(path)
    alphabet = [*"ab'srevldtm  \n\t!?.,19", "é", "世", "\xa0", "😀", "<|endoftext|>", "word ", " " * 70, "é" * 70]
    hostile = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 30))) for _ in range(150)]
    for text in hostile:
        table, total = prefixes.table(text)
        for budget in (0, 1, 2, 5, 17, 60, total):
            assert prefixes.count_within(text, budget) == (total, token_counts.prefix_length(table, budget))
    monkeypatch.setattr(prefixes, "table", None)
    assert prefixes.count_within("two words " * 900, 1024)[1] < 9000


def test_mixing_reaches_its_targets(docs, labels):
    rates, mix, _ = mixing.mixed(docs, labels)
    rows = rates.collect()
    total = sum(r.tokens for r in rows)
    reached = [sum(r.tokens * r.rate * r.posterior[i] for r in rows) for i in range(len(mix.domains))]
    assert all(r.rate >= 0 for r in rows)
    assert reached == pytest.approx(mix.reached, rel=1e-9) and sum(mix.targets) == pytest.approx(total)
    assert mixing.add_rate(docs, labels, "rate").columns == [*docs.columns, "rate"]


def test_toxicity_learns_folds_and_spares(spark):
    rng = random.Random(1)
    rows, marks = [], []
    for i in range(200):
        w = [rng.choice(["sun", "moon", "tree", "lake", "river"]) for _ in range(20)]
        if i % 4 == 0:
            w[3] = rng.choice(["blarg", "blargish"])
        elif i % 4 == 1:
            w[3:5] = ["blarg", "beetle"]
        rows.append((i, " ".join(w)))
        marks.append((i, 1, int(i % 4 == 0)))
    docs, labels = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(marks, LABELS)
    lexicon = toxicity.fit(docs, common.chosen_labels(labels, "toxic", 1000))
    new = [(1, "sun B1arg moon"), (2, "a Ьlаrgish tree".replace("Ь", "b")), (3, "sun moon tree"), (4, ""), (5, None)]
    got = by_id(toxicity.scores(spark.createDataFrame(new, "doc_id long, text string"), lexicon))
    assert got[2].predicted == 1 and [got[i].predicted for i in (3, 4, 5)] == [0, 0, 0]


def test_fingerprints(docs):
    source = known()
    got = by_id(fingerprints.report(docs, 64))
    ids = sorted(source)
    for k, i in enumerate(ids):
        text, after = source[i], source[ids[(k + 1) % len(ids)]]
        half = len(text) // 2
        a, b = Counter(words(text)), Counter(words(text[: len(text) - half] + after[:half]))
        true = sum((a & b).values()) / sum((a | b).values()) if a or b else 1.0
        assert got[i].n_chars == len(text) and abs(got[i].near_edited - true) < 0.3
    assert got[0].fingerprint == got[1].fingerprint and got[0].near_next == 1.0


def test_language_model_base(docs):
    out = common.fold  # crc32 of the id as text
    got = by_id(language_model.score(docs, out(docs["doc_id"], 7, 2)))
    tokens = {i: [*words(t), None] for i, t in known().items()}
    counts = Counter(w for i, t in tokens.items() if zlib.crc32(str(i).encode()) % 7 != 2 for w in t)
    counts.update([*words(texts()[0][1]), None])  # the row without id is for training
    n, v = sum(counts.values()), len(counts)
    import math

    for i, t in tokens.items():
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in t)
        assert got[i].base_score == pytest.approx(base) and got[i].train_tokens == n
        assert got[i].n_known == sum(counts[w] > 0 for w in t) and got[i].score < 0


def test_suffix_dedup(docs):
    source = {i: t.encode() for i, t in known().items()}
    starts = defaultdict(int)
    for t in source.values():
        for k in range(len(t) - 399):
            starts[t[k : k + 400]] += 1
    got = by_id(suffix_dedup.remove_repeats(docs))
    for i, t in source.items():
        gone = [False] * len(t)
        for k in range(len(t) - 399):
            if starts[t[k : k + 400]] > 1:
                gone[k : k + 400] = [True] * 400
        assert bytes(got[i].kept) == bytes(b for b, g in zip(t, gone, strict=True) if not g)


def test_line_dedup(docs):
    earlier: list[frozenset] = []
    gone = defaultdict(list)
    for i, t in known().items():
        for k, line in enumerate(t.split("\n")):
            s = frozenset(lower(line).split())
            if len(s) >= 5:
                if any(100 * len(s & e) >= 90 * len(s | e) for e in earlier):
                    gone[i].append(k)
                earlier.append(s)
    got = by_id(line_dedup.report(docs))
    assert {i: list(r.removed) for i, r in got.items() if r.n_removed} == dict(gone)
    cleaned = line_dedup.remove_lines(docs)
    assert cleaned.columns == docs.columns and cleaned.count() == docs.count()


def test_quality_rejects_signs(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    labels = spark.read.parquet(f"{small}/labels.parquet")
    junk = spark.createDataFrame([(10**6, "|| %% $$ ## || %% $$ ## ||", "en", "s", 1), (10**6 + 1, None, None, None, None)], docs.schema)
    got = by_id(quality.report(docs.unionByName(junk), labels))
    assert got[10**6].rejected and not got[10**6 + 1].rejected


def test_empty_tables(spark, empty, labels):
    none = spark.createDataFrame([], LABELS)
    benchmark = spark.createDataFrame([], "item_id long, text string")
    assert ngram_join.link_components(empty).count() == 0
    assert decontamination.hit_report(empty, benchmark).count() == 0
    assert mixing.mixed(empty, none)[0].count() == 0
    assert quality.report(empty, none).count() == 0
    assert line_dedup.report(empty).count() == 0
    assert suffix_dedup.remove_repeats(empty).count() == 0
    assert fingerprints.report(empty).count() == 0
    assert language_model.score(empty, common.fold(empty["doc_id"], 7, 2)).count() == 0
    assert toxicity.scores(empty, toxicity.fit(empty, common.chosen_labels(none, "toxic", 10))).count() == 0


def test_toxicity_does_not_depend_on_file_splits(spark, tmp_path):
    """A toxic phrase that other files hold clean is no exception, however rows are dealt."""
    rng = random.Random(4)
    words_of = ["sun", "moon", "tree", "lake", "river", "stone"]
    rows = [(i, " ".join(rng.choice(words_of) for _ in range(12)) + (" blarg beetle" if i < 60 or i >= 296 else "")) for i in range(300)]
    marks = [(i, 1, int(i < 60)) for i in range(300)]
    labels = common.chosen_labels(spark.createDataFrame(marks, LABELS), "toxic", 1000)
    found = []
    for k, parts in enumerate((1, 5, 40, None)):
        docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts or 1)
        if parts is None:  # the clean uses in a file of their own
            path = str(tmp_path / f"split{k}")
            for here in ("doc_id < 60", "doc_id >= 60"):
                docs.where(here).coalesce(1).write.mode("append").parquet(path)
            docs = spark.read.parquet(path)
        lexicon = toxicity.fit(docs, labels)
        assert not any("beetle" in phrase for phrase in lexicon.exceptions)
        new = spark.createDataFrame([(1, "a blarg beetle"), (2, "sun"), (3, "bl4rg")], "doc_id long, text string")
        found.append({i: (round(r.score, 9), r.predicted) for i, r in by_id(toxicity.scores(new, lexicon)).items()})
    assert found[0] == found[1] == found[2] == found[3] and found[0][1][1] == 1


def test_ngram_join_of_families_that_contract_slowly(spark):
    """Chains and families of near copies that share lists with others, against brute force."""
    rng = random.Random(9)
    make = lambda n: [f"w{rng.randint(0, 400)}" for _ in range(n)]
    shared, out = make(30), []
    for _ in range(6):
        base = shared + make(60)
        for _ in range(14):
            base = list(base)
            base[rng.randrange(30, 90)] = f"x{rng.randint(0, 10**6)}"
            out.append(" ".join(base))
    out += [" ".join(shared + make(25)) for _ in range(20)] + [" ".join(make(4)) for _ in range(5)]
    texts_of = dict(enumerate(out))
    for width, percent in ((3, 90), (5, 80)):
        sets = {i: frozenset(tuple(t.split()[k : k + width]) for k in range(max(1, len(t.split()) - width + 1))) for i, t in texts_of.items()}
        root = {i: i for i in sets}
        changed = True
        while changed:
            changed = False
            for a, b in ((a, b) for a in sets for b in sets if root[a] > root[b]):
                if 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                    root[a], changed = root[b], True
        docs = spark.createDataFrame(list(texts_of.items()), "doc_id long, text string").repartition(5)
        got = by_id(ngram_join.link_components(docs, width, percent))
        assert {i: r.component_id for i, r in got.items()} == root


def test_unrelated_sets_on_one_list_are_kept_apart(spark, monkeypatch):
    """Bitmaps grow with the sets, so unrelated sets of any size give no pairs in the last step."""
    rng = random.Random(21)
    make = lambda n: [f"w{rng.randint(0, 10**9)}" for _ in range(n)]
    rows = []
    for size in (300, 700, 6000):
        shared = make(max(20, size // 20))
        rows += [(100 * size + i, " ".join(shared + make(size))) for i in range(8)]
    docs, met = spark.createDataFrame(rows, "doc_id long, text string"), []
    possible = ngram_join.possible
    monkeypatch.setattr(ngram_join, "possible", lambda pairs, *more: met.append(pairs.count()) or possible(pairs, *more))
    got = by_id(ngram_join.link_components(docs, 5, 80))
    assert all(r.component_id == i for i, r in got.items())
    assert len(met) > 2 and met[-1] == 0  # the first two are the candidates and the neighbours


def test_sets_meet_across_bitmap_sizes(spark):
    """Of sets that are all on one list, each linked pair is met once, whatever their bitmaps."""
    rng = random.Random(22)
    make = lambda n: [f"w{rng.randint(0, 10**9)}" for _ in range(n)]
    base, rows = make(9500), []
    for size in (40, 210, 250, 262, 330, 500, 540, 1010, 1040, 1300, 4000, 4200, 8100, 8300, 9400):
        rows += [(2 * size, " ".join(base[:size])), (2 * size + 1, " ".join(base[size // 25 : size] + make(size // 50)))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    grams = {i: {tuple(t[k : k + 3]) for k in range(len(t) - 2)} for i, t in ((i, t.split()) for i, t in rows)}
    for percent in (80, 40):
        linked = {
            (a, b) for a in grams for b in grams if a > b and 100 * len(grams[a] & grams[b]) >= percent * len(grams[a] | grams[b])
        }
        sets = common.stored(ngram_join.document_sets(docs, 3, percent, ngram_join.heavy_shingles(docs, 3)), "test-sets")
        lists = sets.selectExpr("doc_id", "doc_id as root", "n", "1L as s")
        steps = [ngram_join._met(lists, sets, w, percent) for w in (4, 8, 16, 32, 64, 128)]
        met = [tuple(p) for p in reduce(DataFrame.unionByName, steps).collect()]
        assert len(met) == len(set(met)) and linked <= set(met) and len(linked) > 20
        kept = ngram_join.possible(spark.createDataFrame(sorted(linked), "a long, b long"), sets, percent)
        assert kept.count() == len(linked)


def test_line_dedup_of_crowded_words(spark):
    """Lines of few frequent words, unrelated ones and near copies, against brute force."""
    rng = random.Random(12)
    common_words = [f"c{i}" for i in range(25)]
    rows = []
    for i in range(60):
        lines = [" ".join(rng.sample(common_words, rng.randint(5, 14))) for _ in range(8)]
        lines += [" ".join(f"r{rng.randint(0, 3000)}" for _ in range(rng.randint(5, 40))) for _ in range(3)]
        rows.append((i, "\n".join(lines)))
    long = rows[3][1].split("\n")[-1].split()
    rows += [(100 + k, " ".join(long[:-1] + [f"z{k}"])) for k in range(6)] + [(200, rows[5][1].upper()), (201, "a b c d e")]
    earlier: list[frozenset] = []
    gone = defaultdict(list)
    for i, t in rows:
        for k, line in enumerate(t.split("\n")):
            s = frozenset(lower(line).split())
            if len(s) >= 5:
                if any(100 * len(s & e) >= 90 * len(s | e) for e in earlier):
                    gone[i].append(k)
                earlier.append(s)
    for parts in (1, 7):
        got = by_id(line_dedup.report(spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)))
        assert {i: list(r.removed) for i, r in got.items() if r.n_removed} == dict(gone)


def test_quality_does_not_depend_on_partitions(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    labels = spark.read.parquet(f"{small}/labels.parquet")
    seen = [by_id(quality.report(docs.repartition(n), labels)) for n in (1, 17)]
    assert {i: r.rejected for i, r in seen[0].items()} == {i: r.rejected for i, r in seen[1].items()}
    assert all(seen[0][i].perplexity == pytest.approx(seen[1][i].perplexity, rel=1e-9) for i in seen[0])
