"""Quality classifier, vector codes and filter diagrams against brute force."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import zstandard

from viewmart.llm import cover_tree_codes as codes
from viewmart.llm import filter_diagrams as diagrams
from viewmart.llm import zstd_quality

SF = "/root/testdata/sf0.01"
DOCS = "doc_id bigint, text string, source string, part string, mask int, l_id bigint, rows int, quality int"


def docs_of(spark, rows):
    """Documents with columns whose names the operators use themselves."""
    return spark.createDataFrame([(*r, "p", 1, 2, 3, 1) for r in rows], DOCS).repartition(3)


def labels_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int")


# --- filter diagrams -----------------------------------------------------------------------


def failures(text, copied):
    own = re.findall(r"[^\x20\x09-\x0D]+", text)
    return {
        "A": len(own) < 50,
        "B": 100 * len(set(own)) < 65 * len(own),
        "C": 100 * len(re.findall("[A-Z]", text)) > 5 * len(text),
        "D": bool(re.search(r"[#$%&*|]", text)),
        "E": copied,
    }


def brute_steps(docs, labels):
    """Every order applied to every document."""
    labels = [x for x in labels if x[0] is not None]
    good, toxic = {i for i, q, _ in labels if q == 1}, {i for i, _, t in labels if t == 1}
    least = {}
    for i, text, _ in docs:
        if i is not None:
            least[text or ""] = min(i, least.get(text or "", i))
    parts = {}
    for i, text, source in docs:
        copied = i is not None and i > least[text or ""]
        parts.setdefault(source or "", []).append((i, failures(text or "", copied)))
    out = {}
    for part, rows in parts.items():
        shapley = Counter()
        for order in map("".join, itertools.permutations("ABCDE")):
            left = list(rows)
            for k, f in enumerate(order, 1):
                gone = [(i, x) for i, x in left if x[f]]
                left = [(i, x) for i, x in left if not x[f]]
                shapley[f] += len(gone)
                out[part, order, k] = [
                    len(left),
                    len(gone),
                    sum(x[f] for _, x in rows) - len(gone),
                    sum(x[f] and sum(x.values()) == 1 for _, x in rows),
                    sum(i in good for i, _ in gone),
                    sum(i in toxic for i, _ in gone),
                ]
        for (p, order, k), counts in out.items():
            if p == part:
                counts.append(shapley[order[k - 1]])
    return {key: tuple(counts) for key, counts in out.items()}


def found_steps(docs, labels):
    rows = diagrams.steps_by_order(docs, labels).collect()
    out = {(r.part, r.filter_order, r.step): tuple(r[c] for c in diagrams.COUNTS) for r in rows}
    assert len(out) == len(rows)
    return out


def test_neighbour_swaps_visit_every_order():
    for n in range(1, 6):
        order, seen = list(range(n)), [tuple(range(n))]
        for k in diagrams.neighbour_swaps(n):
            order[k : k + 2] = reversed(order[k : k + 2])
            seen.append(tuple(order))
        assert len(seen) == len(set(seen)) == len(list(itertools.permutations(range(n))))


@pytest.mark.parametrize("seed", range(20))
def test_swaps_keep_what_a_diagram_counts(seed):
    rng = random.Random(seed)
    masks = {m: (n := rng.randint(1, 3), rng.randint(0, n), 0) for m in rng.sample(range(32), rng.randint(1, 32))}
    diagram = diagrams.Diagram(masks)
    for k in rng.choices(range(4), k=60):
        diagram.swap(k)
        names = "".join(diagram.order)
        for mask, weight in masks.items():
            node = diagram.root
            for f in names:
                node = diagram.branches[node][0 if mask >> "ABCDE".index(f) & 1 else 1]
            assert diagram.weight[node] == weight
        for level in diagram.level:  # equal subtrees are one node
            assert len({diagram.branches[n] for n in level}) == len(level)


def odd_documents(seed):
    rng = random.Random(seed)
    texts = [
        None,
        "",
        " \t\n",
        "word " * 60,
        " ".join(f"w{k}" for k in range(60)),
        " ".join(f"W{k}" for k in range(60)),
        "a # b",
        "É" * 300 + "A" * 20,
        " ".join(f"x{k % 40}" for k in range(60)) + " |",
        "longest " * 60_000,
    ]
    rows = [(rng.choice([*range(30), None]), rng.choice(texts), rng.choice(["a", "b", "", None])) for _ in range(120)]
    return rows + [(7, "again", "a")] * 9 + [(k, "copy", "hot") for k in range(90)]


@pytest.mark.parametrize("seed", range(2))
def test_steps_equal_applying_every_order(spark, seed):
    rows = odd_documents(seed)
    rng = random.Random(seed)
    labels = [(rng.choice([*range(60), None]), rng.choice([0, 1, None]), rng.choice([0, 1, None])) for _ in range(50)]
    assert found_steps(docs_of(spark, rows), labels_of(spark, labels)) == brute_steps(rows, labels)


def test_no_documents_or_labels(spark):
    assert found_steps(docs_of(spark, []), labels_of(spark, [(1, 1, 1)])) == {}
    rows = [(1, "a b", "s"), (2, "a b", None)]
    assert found_steps(docs_of(spark, rows), labels_of(spark, [])) == brute_steps(rows, [])


# --- vector codes --------------------------------------------------------------------------


def brute_codes(rows):
    """Lloyd's rounds comparing every vector with every entry."""
    kept = [r for r in rows if r[1] is not None and all(x is not None and np.isfinite(x) for x in r[1])]
    points = np.floor(np.array([r[1] for r in kept], np.float64) * 4096).astype(np.int64).reshape(len(kept), -1)
    first = {}
    for k, (i, v, _) in enumerate(kept):
        if i not in first or v < kept[first[i]][1]:
            first[i] = k
    start = [first[i] for i in sorted(first, key=lambda i: (i is None, i))][:16]
    parts, books = np.split(points, 8, axis=1), [p[start] for p in np.split(points, 8, axis=1)]

    def nearest(p, book):
        return ((p[:, None, :] - book[None]) ** 2).sum(axis=2).argmin(axis=1)

    for _ in range(6):
        for p, book in zip(parts, books, strict=True):
            at = nearest(p, book)
            for e in set(at.tolist()):
                book[e] = p[at == e].sum(axis=0) // (at == e).sum()
    at = np.stack([nearest(p, b) for p, b in zip(parts, books, strict=True)], axis=1)
    errors = sum(((p - b[a]) ** 2).sum(axis=1) for p, b, a in zip(parts, books, at.T, strict=True))
    by_label = Counter()
    for (_, _, label), e in zip(kept, errors.tolist(), strict=True):
        by_label[label] += e
    text = ",".join(str(x) for b in books for x in b.ravel().tolist())
    digest = hashlib.sha256(text.encode()).hexdigest()
    return Counter(
        (i, "".join(f"{x:02x}" for x in a), e, by_label[label], digest)
        for (i, _, label), a, e in zip(kept, at.tolist(), errors.tolist(), strict=True)
    )


def found_codes(spark, rows):
    schema = "vec_id bigint, embedding array<float>, label int, code string, s_label int, n int"
    frame = spark.createDataFrame([(*r, "c", 1, 2) for r in rows], schema).repartition(3)
    return codes.coded(frame)


def vectors(seed, n, length=16):
    rng = np.random.default_rng(seed)
    kinds = [
        rng.normal(0, 0.2, (n, length)),
        rng.integers(-2, 3, (n, length)) / 4096,  # ties
        np.repeat(rng.normal(0, 1, (1, length)), n, axis=0),  # one point
        rng.normal(0, 0.01, (n, length)) + rng.integers(0, 3, (n, 1)),
    ]
    rows = np.concatenate(kinds)[rng.permutation(4 * n)[:n]].astype(np.float32)
    ids, labels = rng.permutation(n).tolist(), rng.integers(0, 4, n).tolist()
    return [(ids[k], rows[k].tolist(), labels[k] or None) for k in range(n)]


@pytest.mark.parametrize(("seed", "n"), [(1, 300), (2, 9), (3, 1), (4, 16), (5, 900)])
def test_codes_equal_comparing_everything(spark, seed, n):
    rows = vectors(seed, n)
    rows += [(1000, None, 1), (1001, [None] + [0.0] * 15, 1), (1002, [float("nan")] * 16, None)]
    rows += [(1003, [float("-inf")] * 16, 2), (None, rows[0][1], 1), (rows[0][0], rows[-1][1], 3), rows[0], rows[0]]
    found = found_codes(spark, rows)
    ours = Counter(tuple(r) for r in found.select("vec_id", "code", "error", "label_error", "codebooks_sha256").collect())
    assert ours == brute_codes(rows)


def test_vectors_of_other_lengths_and_sizes(spark):
    rows = vectors(6, 40)
    odd = [(500, [0.5] * 15, 1), (501, [], 2), (502, [0.5] * 24, 77)]
    found = {r.vec_id: r for r in found_codes(spark, rows + odd).collect()}
    assert all(found[i].code is None and found[i].error is None for i, _, _ in odd)
    plain = {r[0]: r[1:3] for r in brute_codes(rows)}
    assert {i: (r.code, r.error) for i, r in found.items() if i < 500} == plain
    assert found_codes(spark, []).count() == 0
    assert {r.code for r in found_codes(spark, [(1, [0.5] * 3, 1), (2, [0.1], 1)]).collect()} == {None}
    empty = found_codes(spark, [(1, [], 1), (2, [], 2)]).collect()
    assert {(r.code, r.error) for r in empty} == {("00" * 8, 0)}
    huge = found_codes(spark, [(k, [3e38 * (-1) ** k] * 16, 1) for k in range(40)]).collect()
    assert len(huge) == 40 and all(r.error >= 0 for r in huge)


def test_trees_cover_their_points_and_prune(spark):
    rng = np.random.default_rng(9)
    points = np.concatenate([rng.normal(c, 30, (700, 4)) for c in (0, 5000, -9000)]).astype(np.int64)
    points = np.concatenate([points, np.repeat(points[:1], 500, axis=0)])
    tree = codes.CoverTree.unpacked(codes.CoverTree.built(points).packed())
    assert sorted(tree.order.tolist()) == list(range(len(points)))
    for i, (a, b) in enumerate(tree.span):
        below = points[tree.order[a:b]]
        assert (tree.sums[i] == below.sum(axis=0)).all()
        apart = codes.squared(below, points[tree.point[i]])
        assert np.sqrt(apart.max()) <= tree.radius[i] * (1 + 1e-12)
    entries = points[[0, 700, 1400]]
    whole, chosen, leaves, _ = tree.descended(points, entries)
    assert len(leaves) == 0 and len(whole) < 50  # three far clusters need no point compared
    counts, _ = tree.summed(points, entries)
    assert counts.tolist() == [1200, 700, 700]


# --- quality classifier --------------------------------------------------------------------


def quality_rows(n, seed=0):
    """Good prose of many syllables, and bad rows of marks."""
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        good = rng.random() < 0.6
        own = ["".join(rng.choices(["ka", "to", "ri", "ne", "su"], k=rng.randint(1, 4))) for _ in range(rng.randint(5, 120))]
        rows.append((i, " ".join(own) if good else " ".join(w.upper() + "!!" for w in own), "s"))
        labels.append((i, int(good), 0))
    return rows, labels


def test_held_out_rows_of_the_fixture(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    rows = zstd_quality.scored(docs, labels).join(labels, "doc_id").where("held_out").collect()
    right = sum(r.predicted == r.quality for r in rows) / len(rows)
    assert len(rows) > 50 and right > 0.9
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)


def test_sizes_scores_and_folds(spark):
    rows, labels = quality_rows(400)
    rows += [(1000, None, None), (1001, "", "s"), (None, "kato rine", "s"), (1002, "ka " * 200_000, "s"), rows[0], rows[0]]
    labels += [(1000, 1, 0), (3, 1 - labels[3][1], 0), (1, None, 0), (None, 1, 1)]
    docs, marks = docs_of(spark, rows), labels_of(spark, labels)
    known = zstd_quality.learning_labels(marks)
    ids = {r.l_id for r in known.collect()}
    assert ids == {i for i, _, _ in labels if i not in (None, 1, 3) and zlib.crc32(str(i).encode()) % 5}
    made = zstd_quality.dictionaries(zstd_quality.sampled_texts(docs.select("doc_id", "text"), known))
    found = zstd_quality.scored(docs, marks).collect()
    assert len(found) == len(rows)
    sizes = {}
    for i, text, _ in rows:
        body = (text or "").encode()
        both = []
        for label in (0, 1):
            own = zstandard.ZstdCompressionDict(made[label])
            own.precompute_compress(level=3)
            tool = zstandard.ZstdCompressor(level=3, dict_data=own, write_content_size=False)
            both.append(sum(len(tool.compress(body[k : k + 1024])) for k in range(0, len(body), 1024)))
        sizes[i] = (len(body), *both)
    assert all((r.n_bytes, r.bad_bytes, r.good_bytes) == sizes[r.doc_id] for r in found)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in found)
    ranked = sorted(found, key=lambda r: r.measure)
    assert all(a.score <= b.score + 1e-12 for a, b in itertools.pairwise(ranked))
    truth = dict((i, q) for i, q, _ in labels[:400] if i not in (1, 3))
    right = [r.predicted == truth[r.doc_id] for r in found if r.doc_id in truth and r.held_out]
    assert sum(right) / len(right) > 0.95
    again = zstd_quality.scored(docs.repartition(5), marks).collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, found))


def test_the_sample_is_bounded(spark):
    rows = [(i, " ".join(f"w{i}x{k}" for k in range(400)), "s") for i in range(300)]
    rows += [(i % 7, "same text " * 200, "s") for i in range(500)] + [(400, "long " * 50_000, "s"), (401, "", "s")]
    labels = [(i, i % 3 and 1, 0) for i in range(402)]
    docs, known = docs_of(spark, rows).select("doc_id", "text"), zstd_quality.learning_labels(labels_of(spark, labels))
    ids = zstd_quality.sampled_ids(docs, known, most=64).collect()
    assert len({r.s_id for r in ids}) == len(ids) and not {400, 401} & {r.s_id for r in ids}
    for quality in (0, 1):
        n = {r.s_id: -(-len(rows[r.s_id][1]) // 1024) for r in ids if r.quality == quality}
        assert 50 < sum(n.values()) <= 64
    texts = docs.join(known, docs["doc_id"] == known["l_id"]).select("quality", "text")
    assert max(Counter(r.quality for r in zstd_quality.sampled_pieces(texts, most=50).collect()).values()) == 50


def test_scores_see_no_other_column(spark):
    rows, labels = quality_rows(200, seed=2)
    twice = [*rows, *((i + 100_000, t, "other source") for i, t, _ in rows)]
    found = {r.doc_id: r.score for r in zstd_quality.scored(docs_of(spark, twice), labels_of(spark, labels)).collect()}
    assert all(found[i] == found[i + 100_000] for i, _, _ in rows)


def test_without_labels_of_both_kinds(spark):
    rows, labels = quality_rows(60, seed=3)
    assert {r.score for r in zstd_quality.scored(docs_of(spark, rows), labels_of(spark, [])).collect()} == {0.5}
    one = [(i, 1, 0) for i, _, _ in labels]
    assert {r.score for r in zstd_quality.scored(docs_of(spark, rows), labels_of(spark, one)).collect()} == {1.0}
    assert zstd_quality.scored(docs_of(spark, []), labels_of(spark, labels)).count() == 0
    few = labels_of(spark, [(0, 1, 0), *((i, 0, 0) for i in range(1, 30))])
    assert zstd_quality.scored(docs_of(spark, rows), few).count() == 60
