"""Jaccard join, decontamination, language model, url rules and page text against brute force."""

import itertools
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from viewmart.llm import deleted_interpolation as lm
from viewmart.llm import dom_trees, fragment_join, url_rules, wand_decontamination

SF = "/root/testdata/sf0.001"


def docs_of(spark, rows):
    schema = "doc_id bigint, text string, n bigint, key string, fold string, text_key int, component_id int, row int"
    return spark.createDataFrame([(*r, 5, "k", "f", 1, 2, 3) for r in rows], schema).repartition(3)


# --- Jaccard join --------------------------------------------------------------------------


def gram_set(text, words=4):
    w = (text or "").encode().lower().split()
    n = min(words, len(w))
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if n else set()


def components(rows, words=4, percent=85):
    """doc_id -> (set size, least doc_id of its component), comparing all pairs."""
    sets = [(i, gram_set(t, words)) for i, t in rows]
    parent = list(range(len(sets)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, (_, x) in enumerate(sets):
        for b in range(a):
            y = sets[b][1]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                parent[root(a)] = root(b)
    least = {}
    for k, (i, _) in enumerate(sets):
        least[root(k)] = min(least.get(root(k), i), i)
    return {i: (len(s), least[root(k)]) for k, (i, s) in enumerate(sets)}


def near_copies(seed, groups=12):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(400)]
    rows = []
    for _ in range(groups):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([3, 5, 8, 30, 60, 120]))]
        for _ in range(rng.choice([1, 2, 9, 25])):
            words = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            if rng.random() < 0.2:
                words = words[: -rng.randint(1, 4)] or words
            rows.append(" ".join(words).upper() if rng.random() < 0.1 else " ".join(words))
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("seed,share", [(1, 5), (2, 5), (3, 2)])
def test_components_equal_brute_force(spark, seed, share):
    rows = near_copies(seed)
    out = fragment_join.joined(docs_of(spark, rows), share=share).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in out} == components(rows)


def test_components_without_pivots_that_reach_all(spark):
    """A chain: each text is near the next alone, so pivots can't link all."""
    words = [f"c{k}" for k in range(160)]
    rows = [(k, " ".join(words[k : k + 100])) for k in range(0, 60, 4)] + [(100, "other words that stand alone here")]
    out = fragment_join.joined(docs_of(spark, rows)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in out} == components(rows)


def test_size_bands_of_sizes_that_may_link_are_neighbours(spark):
    for percent in (50, 80, 85, 99, 100):
        n = 400
        sizes = spark.range(1, n + 1)
        band = [r[0] for r in sizes.orderBy("id").select(fragment_join.size_band("id", percent)).collect()]
        for b in range(1, n + 1):
            for a in range(-(-percent * b // 100), b + 1):
                assert abs(band[a - 1] - band[b - 1]) <= 1, (percent, a, b)


def test_last_round_makes_pairs_of_like_sizes_only(spark):
    """One bucket of sets of all sizes that do not link: every pair that may link is made, and no other meets."""
    rng = random.Random(3)
    rows = [(7, k, rng.choice([10, 11, 12, 40, 43, 160, 200, 235]), 0, 0) for k in range(120)]
    members = spark.createDataFrame(rows, "gram bigint, key bigint, n bigint, own bigint, place bigint").withColumn(
        "component", F.struct("n", "key")
    )
    got = {frozenset([(r.a, r.n_a), (r.b, r.n_b)]) for r in fragment_join.all_pairs_apart(members, 85).collect()}
    sizes = [(k, n) for _, k, n, *_ in rows]
    assert got == {frozenset([x, y]) for x in sizes for y in sizes if x < y and 100 * min(x[1], y[1]) >= 85 * max(x[1], y[1])}
    plan = fragment_join.all_pairs_apart(members, 85)._jdf.queryExecution().optimizedPlan().toString()
    assert "band" in plan


def test_components_on_the_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    out = fragment_join.joined(docs).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in out} == components(rows)


def test_join_of_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, " \n"), (4, "a"), (4, "a"), (5, "A"), (None, "a"), (None, "x y"), (6, "w " * 5000)]
    out = sorted((r.doc_id or 0, r.n_shingles, r.component_id) for r in fragment_join.joined(docs_of(spark, rows)).collect() if r.doc_id)
    assert out == [(1, 0, 1), (2, 0, 2), (3, 0, 3), (4, 1, 4), (4, 1, 4), (5, 1, 4), (6, 1, 6)]
    frame = docs_of(spark, rows)
    kept = fragment_join.one_of_each(frame)
    assert kept.columns == frame.columns
    assert sorted((r.doc_id or 0, r.text) for r in kept.collect() if r.text) == [(0, "x y"), (3, " \n"), (4, "a"), (4, "a"), (6, "w " * 5000)]
    assert fragment_join.joined(docs_of(spark, [])).count() == 0


# --- decontamination -----------------------------------------------------------------------


def plain_words(text):
    """Letters, digits and characters outside ASCII; A-Z lower-cased."""
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[a-z0-9\x80-\U0010ffff]+", lowered)


def runs_of_three(words):
    if len(words) < 3:
        return {tuple(words)} if words else set()
    return set(zip(words, words[1:], words[2:]))


def share_in(part, words):
    wanted = runs_of_three(part)
    n = min(3, len(part))
    held = {tuple(words[k : k + n]) for k in range(len(words) - n + 1)}
    return len(wanted & held) / len(wanted) if wanted else 1.0


def split_item(text):
    """Question and answer: all sentences but the last and the last, or three quarters and the rest."""
    parts = [w for w in (plain_words(x) for x in re.split(r"(?<=[.!?])\s+|\n+", text)) if w]
    if len(parts) > 1:
        return sum(parts[:-1], []), parts[-1]
    rest = max(1, len(parts[0]) // 4)
    return parts[0][:-rest], parts[0][-rest:]


def brute_leaks(docs, items):
    """BM25 of every passage against every item, without an index and without the operator's own helpers."""
    terms = {i: plain_words(t) for i, t in items}
    terms = {i: w for i, w in terms.items() if w}
    parts = {i: split_item(t) for i, t in items if i in terms}
    df = Counter(w for words in terms.values() for w in set(words))
    mean = sum(map(len, terms.values())) / len(terms)
    impact = {}
    for i, words in terms.items():
        raw = {
            w: math.log1p((len(terms) - df[w] + 0.5) / (df[w] + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(words) / mean))
            for w, tf in Counter(words).items()
        }
        impact[i] = {w: x / sum(raw.values()) for w, x in raw.items()}
    longest = max(map(len, terms.values()))
    found = set()
    for d, text in docs:
        words = plain_words(text)
        # windows of twice the longest item, one longest item apart, the last one up to the end
        start = 0
        while True:
            held = words[start : start + 2 * longest]
            for i, (question, answer) in parts.items():
                if sum(x for w, x in impact[i].items() if w in set(held)) < 0.5 - 1e-9:
                    continue
                both = share_in(question, held) >= 0.6 and share_in(answer, held) >= 0.5
                short = len(runs_of_three(answer)) < 6 and share_in(question + answer, held) >= 0.6
                if both or short:
                    found.add((d, i))
            if start + 2 * longest >= len(words):
                break
            start += longest
    return found


def bench_of(spark, rows):
    return spark.createDataFrame([(*r, 1.5) for r in rows], "item_id int, text string, score double")


def test_leaks_equal_brute_force_on_the_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    tests = [(r.item_id, r.text) for r in items.collect()]
    got = {(r.doc_id, r.item_id) for r in wand_decontamination.leaks(docs, items).collect()}
    assert got == brute_leaks(rows, tests) and got
    # every document that holds an item word for word is among them
    plain = lambda t: b" ".join(wand_decontamination.terms_of(t))
    assert {(d, i) for d, t in rows for i, x in tests if plain(x) in plain(t)} <= got


def test_leaks_by_shards_and_odd_rows(spark):
    rng = random.Random(4)
    words = [f"t{k}" for k in range(300)]
    items = [(k, " ".join(rng.choice(words) for _ in range(rng.randint(4, 30))) + ". " + rng.choice(words)) for k in range(40)]
    items += [(90, None), (91, ""), (92, "..."), (5, items[5][1])]
    docs = [(k, " ".join(rng.choice(words) for _ in range(rng.randint(0, 200))) + " " + (items[k % 40][1] if k % 3 == 0 else "")) for k in range(60)]
    docs += [(70, None), (71, ""), (72, items[7][1] + " x " * 20_000), (None, items[1][1]), (0, docs[0][1])]
    frame, tests = docs_of(spark, docs), bench_of(spark, items)
    expected = brute_leaks(docs, items)
    got = [(r.doc_id, r.item_id) for r in wand_decontamination.leaks(frame, tests).collect()]
    assert set(got) == expected
    assert got.count((0, 0)) == 2
    kept = wand_decontamination.decontaminated(frame, tests)
    assert kept.columns == frame.columns
    leaky = {d for d, _ in expected}
    assert sorted(r.doc_id for r in kept.collect()) == sorted(d for d, _ in docs if d not in leaky)
    sharded = {i for index in wand_decontamination.shards(tests, 500) for i in index.items}
    assert sharded == set(range(40))
    assert wand_decontamination.leaks(frame, bench_of(spark, [])).count() == 0
    assert wand_decontamination.leaks(docs_of(spark, []), tests).count() == 0
    assert wand_decontamination.decontaminated(frame, bench_of(spark, [])).count() == len(docs)


def test_lists_of_terms_before_the_pivot_are_not_walked(monkeypatch):
    """Every item holds the same three words, and so does every passage: no block is opened by them."""
    items = [(k, f"which of these x{k} y{k} z{k} v{k} u{k} t{k}. the w{k}") for k in range(4_000)]
    df = Counter(w for _, t in items for w in set(wand_decontamination.terms_of(t)))
    index = wand_decontamination.build_index(items, len(items), 10.0, df)
    walked = []
    plain = wand_decontamination._expanded
    monkeypatch.setattr(
        wand_decontamination, "_expanded", lambda starts, terms: walked.append(int((starts[terms + 1] - starts[terms]).sum())) or plain(starts, terms)
    )
    assert wand_decontamination.hits(index, ["which of these the " * 500]) == [] and sum(walked) == 0
    got = wand_decontamination.hits(index, ["which of these the " * 50 + items[77][1], "x5 y6 z7 of these"])
    assert [(number, index.items[item]) for number, item, *_ in got] == [(0, 77)]
    assert sum(walked) < 100  # the four common words alone stand in 500 blocks each


def test_memory_does_not_grow_with_a_text():
    """A text of a million words against 20,000 short items, a word of each in it."""
    import tracemalloc

    rng = random.Random(8)
    items = [(k, f"a{rng.randrange(900)} b{rng.randrange(900)} c{k} d{k}. e{k}") for k in range(20_000)]
    df = Counter(w for _, t in items for w in set(wand_decontamination.terms_of(t)))
    index = wand_decontamination.build_index(items, len(items), 5.0, df)
    text = " ".join(f"{rng.choice('abc')}{rng.randrange(900)}" for _ in range(1_000_000))
    most = []
    for part in (text[: len(text) // 4], text):
        tracemalloc.start()
        got = wand_decontamination.hits(index, [part + " " + items[123][1]])
        most.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
        assert 123 in {index.items[item] for _, item, *_ in got}
    # beyond one portion, only the words themselves and their numbers
    assert most[1] - most[0] < 120 * 750_000


def test_copies_with_a_changed_or_missing_last_sentence_leak(spark):
    question = " ".join(f"q{k}" for k in range(24)) + "."
    short, four = "The answer word.", "One two three four."
    long = " ".join(f"a{k}" for k in range(12)) + "."
    single = " ".join(f"s{k}" for k in range(16))  # its last quarter is the answer
    items = [(1, f"{question} {short}"), (2, f"{question.replace('q', 'r')} {four}"), (3, f"{question.replace('q', 't')} {long}"), (4, single)]
    pad = " ".join(f"p{k}" for k in range(80))
    docs = {
        "changed": f"{question} The other word.",
        "cut": question,
        "middle": f"{question.replace('q', 'r')} One two five four.",
        "single": " ".join(single.split()[:13]),
        "question of a long answer": question.replace("q", "t"),
        "half": " ".join(question.split()[:14]),
        "answer": short,
    }
    frame = docs_of(spark, [(k, f"{pad} {text} {pad}") for k, text in enumerate(docs.values())])
    names = list(docs)
    got = {(names[r.doc_id], r.item_id) for r in wand_decontamination.leaks(frame, bench_of(spark, items)).collect()}
    assert got == {("changed", 1), ("cut", 1), ("middle", 2), ("single", 4)}
    kept = {names[r.doc_id] for r in wand_decontamination.decontaminated(frame, bench_of(spark, items)).collect()}
    assert kept == {"question of a long answer", "half", "answer"}


# --- language model ------------------------------------------------------------------------


def test_scores_equal_plain_counts(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.text.encode().lower().split() + [None]) for r in docs.collect()]
    held = lambda d: zlib.crc32(str(d).encode()) % 7 == 2
    one, two = Counter(), Counter()
    for d, words in rows:
        if not held(d):
            one.update(words)
            two.update(zip([0, *words[:-1]], words))
    n, v = sum(one.values()), len(one)
    documents = sum(not held(d) for d, _ in rows)
    out = {r.doc_id: r for r in lm.scored(docs, block_rows=37).collect()}
    assert len(out) == len(rows)
    for d, words in rows:
        r = out[d]
        assert (r.held_out, r.n_tokens, r.train_tokens) == (held(d), len(words), n)
        assert r.n_known == sum(one[w] > 0 for w in words)
        assert r.base_score == pytest.approx(sum(math.log10((one[w] + 1) / (n + v + 1)) for w in words))
    assert {r.doc_id: r.score for r in lm.scored(docs).collect()} == pytest.approx({d: r.score for d, r in out.items()})
    weights = np.tile([0.2, 0.3, 0.5], (65, 1))
    size = lm.Size(n, v, documents, n, v, documents)
    for d, words in rows[:20]:
        p = lm.token_probabilities(
            np.array([one[w] for w in words]), np.array([two[x] for x in zip([0, *words[:-1]], words)]), weights, size
        )
        before = [documents, *(one[w] for w in words[:-1])]
        expected = [
            0.2 / (v + 1) + 0.3 * one[w] / n + (0.5 * two[x] / c if c else 0)
            for w, x, c in zip(words, zip([0, *words[:-1]], words), before)
        ]
        assert p == pytest.approx(expected)
    unseen = [d for d, _ in rows if held(d)]
    assert sum(out[d].score for d in unseen) > sum(out[d].base_score for d in unseen)


def test_weights_are_the_most_likely_ones():
    rng = np.random.default_rng(2)
    p1, p2 = rng.integers(-120, -20, 300), rng.integers(-60, 0, 300)
    cells = np.stack([np.full(300, 3), p1, p2, rng.integers(1, 50, 300)], 1)
    weights = lm.learned_weights(cells, 1000)
    assert weights.sum(1) == pytest.approx(np.ones(65))
    p = np.stack([np.full(300, 1 / 1001), 2.0 ** ((p1 + 0.5) / 8), 2.0 ** ((p2 + 0.5) / 8)], 1)
    likelihood = lambda w: cells[:, 3] @ np.log(p @ w)
    best = likelihood(weights[3])
    for _ in range(200):
        assert likelihood(rng.dirichlet([1, 1, 1])) <= best + 1e-3 * abs(best)


def test_model_of_odd_rows(spark):
    rows = [(1, None), (2, ""), (None, "a b"), (3, "a " * 30_000), (4, "A b"), (4, "A b")]
    out = lm.scored(docs_of(spark, rows)).collect()
    assert len(out) == 6 and all(math.isfinite(r.score) and math.isfinite(r.base_score) for r in out)
    assert {r.n_tokens for r in out if r.doc_id in (1, 2)} == {1}
    assert lm.scored(docs_of(spark, [])).count() == 0
    assert [math.isfinite(r.score) for r in lm.scored(docs_of(spark, [(k, "x") for k in range(40) if zlib.crc32(str(k).encode()) % 7 == 2])).collect()]


def test_a_block_that_changes_is_noticed(spark):
    """Other words, as many as before: only a digest of the keys can tell."""

    def numbered(words):
        rows = [(k, f"{words[k]} a b", k % 7, k, 0) for k in range(len(words))]
        return spark.createDataFrame(rows, "doc_id bigint, text string, fold int, row bigint, block bigint").coalesce(1)

    before = [f"w{k}" for k in range(9)]
    size = lm.Size(36, 12, 8, 32, 12, 7)
    summed = lm.totals(lm.block_counts(numbered(before), 3)).where("block >= 0")
    assert lm.counted(numbered(before), summed, size).where("fold is not null").count() == 9
    with pytest.raises(Exception, match="changed between two reads"):
        lm.counted(numbered([*before[:-1], "other"]), summed, size).collect()


def test_hash_lists_are_packed_exactly():
    rng = np.random.default_rng(0)
    for keys in ([0], [5, 2**64 - 1], sorted(set(rng.integers(0, 2**63, 5000).tolist()))):
        keys = np.array(keys, np.uint64)
        assert (lm._unpack(lm._pack(keys)) == keys).all()


# --- url rules -----------------------------------------------------------------------------


def pages_of(spark, urls):
    return spark.createDataFrame([(k, u, "x", "y") for k, u in enumerate(urls)], "page_id bigint, url string, tokens string, host string")


def test_listed_rules(spark):
    urls = {
        "http://a.NET/x": ("a.net", "/x", "net/", "block"),
        "https://b.example.net/en/1?q=/#f": ("b.example.net", "/en/1", "example.net/en/", "allow"),
        "https://example.net/de/": ("example.net", "/de/", "net/", "block"),
        "//x": ("", "", None, "allow"),
        None: ("", "", None, "allow"),
        "x://badexample.com/de/1": ("badexample.com", "/de/1", None, "allow"),
        "x://example.com/de/1": ("example.com", "/de/1", "example.com/de/", "block"),
        "x://a.net": ("a.net", "", None, "allow"),
        "x://a.org:80/fr/": ("a.org:80", "/fr/", None, "allow"),
        "x://a.org/fr/://b.net/": ("a.org", "/fr/://b.net/", "org/fr/", "allow"),
        "x://?a": ("", "", None, "allow"),
    }
    none = spark.createDataFrame([], "key string, tokens array<string>, confidence double, support double")
    out = url_rules.judged(pages_of(spark, list(urls)), none).collect()
    assert {r.url: (r.host, r.path, r.rule, r.verdict) for r in out} == urls
    assert url_rules.judged(pages_of(spark, []), none).count() == 0


def test_mined_rules_find_a_planted_combination(spark):
    rng = random.Random(6)
    urls, bad = [], []
    for k in range(600):
        host = rng.choice(["good.com", "spam-farm.com", "other.com"])
        section = rng.choice(["shop", "news"])
        urls.append(f"http://{host}/{section}/{k}" + rng.choice(["", "?id=4", "#top"]))
        planted = host == "spam-farm.com" and section == "shop"
        bad.append(rng.random() < (0.95 if planted else 0.05))
    pages = pages_of(spark, [*urls, None, "nothing"])
    labels = spark.createDataFrame([(k, 1 - b, 0) for k, b in enumerate(bad)], "doc_id bigint, quality int, toxic int")
    rules = url_rules.mined_rules(pages, labels)
    found = [set(r.tokens) for r in rules.collect()]
    assert found and all("path=shop" in t for t in found)
    out = {r.url: r for r in url_rules.judged(pages, rules).collect()}
    assert all((out[u].verdict == "block") == ("spam-farm" in u and "/shop/" in u) for u in urls)
    assert out[None].verdict == "allow"
    assert url_rules.mined_rules(pages, labels.where("false")).count() == 0


def hosts_judged(spark, hosts):
    """Verdicts by host of pages from (host, bad pages, good pages)."""
    rows = [(h, b) for h, bad, good in hosts for b in [1] * bad + [0] * good]
    pages = pages_of(spark, [f"http://{h}/p/{k}" for k, (h, _) in enumerate(rows)])
    labels = spark.createDataFrame([(k, 1 - b, 0) for k, (_, b) in enumerate(rows)], "doc_id bigint, quality int, toxic int")
    out = {}
    for r in url_rules.judged(pages, url_rules.mined_rules(pages, labels)).collect():
        out.setdefault(r.host, set()).add(r.verdict)
    return out


def test_a_rare_bad_host_is_found_among_many_pages(spark):
    good = [(f"good{chr(97 + k)}.com", 20, 480) for k in range(20)]
    out = hosts_judged(spark, [*good, ("spam.com", 20, 0), ("few.com", 19, 0)])
    assert out.pop("spam.com") == {"block"}
    assert set(map(frozenset, out.values())) == {frozenset({"allow"})}


def test_a_bad_majority_leaves_rules_to_mine(spark):
    out = hosts_judged(spark, [("hot.com", 1600, 0), ("mixed.com", 150, 50), ("good.com", 10, 190), ("bad.com", 60, 0)])
    assert out == {"hot.com": {"block"}, "mixed.com": {"allow"}, "good.com": {"allow"}, "bad.com": {"block"}}
    assert hosts_judged(spark, [("a.com", 40, 0), ("b.com", 40, 0)]) == {"a.com": {"allow"}, "b.com": {"allow"}}


def passes(bad, held, n_bad, n, min_pages):
    """The thresholds of a rule, written out."""
    base, sure = n_bad / n, bad / held
    if bad < min_pages or sure < 0.6 or sure * (1 - base) < 2.25 * base * (1 - sure):
        return False
    z = 4 / held
    return (sure + z / 2 - 2 * math.sqrt(sure * (1 - sure) / held + z / held / 4)) / (1 + z) > base


@pytest.mark.parametrize("seed", [1, 2])
def test_mining_equals_trying_every_combination(spark, seed):
    rng = random.Random(seed)
    rows = []
    for k in range(160):
        host = rng.choice(["a.com", "b.com", "b.com"])
        path = "/".join(x for x in ("long/common", "p", "q", "r") if rng.random() < 0.6)
        likely = 0.9 if "p/q" in path or host == "a.com" and "r" in path else 0.15
        rows.append((f"http://{host}/{path}/{k}" + rng.choice(["", "?x=1", "?x=1&y=2"]), rng.random() < likely))
    rows += rows[:20]  # repeated urls
    open_ = ["http://a.com/long/1", "http://b.com/p/q", "http://b.com/q/r?y=3", "http://c.com/common/p", "http://a.com/r"]
    pages = pages_of(spark, [u for u, _ in rows] + open_)
    labels = spark.createDataFrame([(k, 1 - b, 0) for k, (_, b) in enumerate(rows)], "doc_id bigint, quality int, toxic int")
    own = {r.page_id: frozenset(r.t) for r in pages.select("page_id", url_rules.tokens_of(F.col("url")).alias("t")).collect()}
    n, n_bad = len(rows), sum(b for _, b in rows)
    every = sorted(frozenset().union(*(own[k] for k, (_, b) in enumerate(rows) if b)))
    good = set()
    for size in range(1, len(every) + 1):
        for tokens in map(frozenset, itertools.combinations(every, size)):
            held = [b for k, (_, b) in enumerate(rows) if tokens <= own[k]]
            if held and not any(g < tokens for g in good) and passes(sum(held), len(held), n_bad, n, 20):
                good.add(tokens)
    assert good and any(len(g) > 1 for g in good)
    rules = url_rules.mined_rules(pages, labels).collect()
    mined = {frozenset(choice) for r in rules for choice in itertools.product(*r.choices)}
    assert mined == good
    for r in url_rules.judged(pages, url_rules.mined_rules(pages, labels)).collect():
        assert (r.verdict == "block") == any(g <= own[r.page_id] for g in good)


def test_long_common_paths_do_not_multiply(spark):
    path = "/".join(f"s{chr(97 + k)}" for k in range(25))
    good = [f"http://good.com/{path}/{k}" for k in range(60)]
    bad = [f"http://spam.com/{path}/x{path}/{k}?{'&'.join(f'q{i}=1' for i in range(25))}" for k in range(30)]
    pages = pages_of(spark, good + bad + ["http://other.com/?q7=2", "http://other.com/sb"])
    labels = spark.createDataFrame([(k, int(k < 60), 0) for k in range(90)], "doc_id bigint, quality int, toxic int")
    out = {r.url: r.verdict for r in url_rules.judged(pages, url_rules.mined_rules(pages, labels)).collect()}
    assert {out[u] for u in bad} == {"block"} and {out[u] for u in good} == {"allow"}
    assert out["http://other.com/?q7=2"] == "block" and out["http://other.com/sb"] == "allow"


def test_rules_match_as_all_rules_tested(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    tokens = {r.url: set(r.t) for r in pages.select("url", url_rules.tokens_of(F.col("url")).alias("t")).collect()}
    every = sorted(set().union(*tokens.values()))
    rng = random.Random(3)
    rules = [(ts[0], ts, 0.5 + k / 1000, 0.1) for k in range(60) for ts in [sorted(rng.sample(every, rng.choice([1, 2, 2, 3])))]]
    frame = spark.createDataFrame(rules, "key string, tokens array<string>, confidence double, support double")
    for r in url_rules.judged(pages, frame).collect():
        hits = [ts for _, ts, _, _ in rules if set(ts) <= tokens[r.url]]
        assert (r.mined is not None) == (bool(hits) and r.rule is None)


# --- page text -----------------------------------------------------------------------------


def article(source):
    """Text of the generated pages' article, by their own fixed form."""
    import html

    inner = re.search(r"<article>(.*?)</article>", source, re.S)[1]
    blocks = re.split(r"</?(?:h1|p|div|ul|li)[^>]*>", inner)
    plain = [" ".join(html.unescape(re.sub(r"<[^>]+>", " " if False else "", re.sub(r"<br>", " ", b))).split()) for b in blocks]
    return "\n\n".join(b for b in plain if b)


def test_text_of_the_pages(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    trees = dom_trees.fitted(pages)
    out = {r.page_id: r for r in dom_trees.extracted(pages, trees).collect()}
    rows = pages.collect()
    exact = sum(out[r.page_id].text == article(r.html) for r in rows)
    assert exact >= 0.98 * len(rows)
    assert all(r.n_chars == len(r.text) for r in out.values())


def test_held_out_layouts(spark):
    """Layouts of pages that are not in the training sample, with their own seeds."""
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    trees = dom_trees.fitted(pages)
    rows = [r.html for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").where("page_id > 200").collect()]
    right = total = 0
    for seed, source in enumerate(rows):
        page = dom_trees.read_page(source)
        blocks = [t for n, t in page.blocks if page.nodes[n].tag in ("h1", "p") and len(t) > 20]
        for made, mark in dom_trees.layouts(blocks, 10_000 + seed, 3):
            before, _, after = made.partition(f' {mark}="1"')
            main = len(dom_trees.read_page(before + ">").nodes) - 1
            made_page = dom_trees.read_page(before + after)
            labels = dom_trees.main_labels(made_page, main)
            kept = dom_trees.kept_nodes(made_page, trees.odds(dom_trees.features(made_page)))
            chars = [(len(t), kept[n] == bool(labels[n])) for n, t in made_page.blocks]
            right += sum(c for c, fine in chars if fine)
            total += sum(c for c, _ in chars)
    assert right >= 0.97 * total


def test_decoding_is_the_best_consistent_choice():
    rng = random.Random(8)
    for _ in range(200):
        n = rng.randint(1, 9)
        parents = [-1] + [rng.randrange(i) for i in range(1, n)]
        nodes = [dom_trees.Node("p", p, 0, frozenset(), frozenset()) for p in parents]
        odds = np.array([rng.uniform(-3, 3) for _ in range(n)])
        kept = dom_trees.kept_nodes(dom_trees.Page(nodes, []), odds)
        best = max(
            sum(o for k, o in enumerate(odds) if mask >> k & 1)
            for mask in range(1 << n)
            if all(not mask >> k & 1 or k == 0 or mask >> parents[k] & 1 for k in range(n))
        )
        assert sum(o for k, o in zip(kept, odds) if k) == pytest.approx(best)
        assert all(not k or p < 0 or kept[p] for k, p in zip(kept, parents))


@pytest.mark.parametrize(
    "source,blocks",
    [
        ("", []),
        ("plain &amp; text", ["plain & text"]),
        ("<p>a<b>b</b> c<br>d<p>e", ["ab c d", "e"]),
        ("<ul><li>x<li>y</ul>z", ["x", "y", "z"]),
        ("<div>a<p>b</div>c", ["a", "b", "c"]),
        ("<script>var t='</p>';</script>ok<style>p{}</style><!-- no <p> -->!", ["ok!"]),
        ("<article><p>1</section></article></b>2", ["1", "2"]),
        ("<p title='a>b'>q</p", ["q</p"]),
        ("<table><tr><td>1<td>2<tr><td>3</table>", ["1", "2", "3"]),
        ("a < b &lt; c <", ["a < b < c <"]),
        ("<p>\u00a0 x \n\t y&nbsp;z</p>", ["x y z"]),
    ],
)
def test_reading(source, blocks):
    assert [t for _, t in dom_trees.read_page(source).blocks] == blocks


@pytest.mark.parametrize(
    ("source", "blocks"),
    [
        ("<a b " * 100_000, 1),
        ('<a "' * 100_001, 1),
        ("<aaaa" * 100_000, 1),
        ("<div>" * 50_000 + "x", 1),
        ("<p><table>" + "<div>x" * 20_000 + "</b>" * 20_000, 20_000),
        ("<b><table>" + "<div>" * 20_000 + "</b>" * 20_000 + "y", 1),
        ("<script/>" * 50_000 + "z", 1),
        ("<a x='\"" * 50_000, 1),
        ("<" * 300_000, 1),
        ("<ul><li><div>q" * 15_000, 15_000),
    ],
)
def test_reading_takes_time_in_proportion(source, blocks):
    import time

    begun = time.process_time()
    page = dom_trees.read_page(source)
    assert time.process_time() - begun < 15 and len(page.blocks) == blocks
    assert dom_trees.features(page).shape[0] == len(page.nodes)


def test_pages_of_odd_rows(spark):
    trees = dom_trees.fitted(spark.read.parquet(f"{SF}/pages.parquet"))
    rows = [(1, None, None), (1, "u", ""), (None, "u", "<p>" * 30_000), (2, "u", "<"), (2, "u", "<")]
    frame = spark.createDataFrame([(*r, "t") for r in rows], "page_id bigint, url string, html string, text string")
    out = dom_trees.extracted(frame, trees).collect()
    assert len(out) == 5 and all(r.n_chars == len(r.text) for r in out)
    assert dom_trees.fitted(frame) is None
    assert dom_trees.extracted(frame, None).count() == 5
    assert dom_trees.extracted(frame.limit(0), trees).count() == 0
