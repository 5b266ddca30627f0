from collections import Counter

import corpus_pipeline
from loadsieve.llm.repetition import measure
from loadsieve.llm.surrogates import entities_of
from tests.llm.test_mixing import brute_targets
from tests.llm.test_packing import check_packing, expected
from tests.llm.test_simhash import brute_fingerprint, brute_groups


def planted(spark, docs):
    """docs, and documents on which other limits would decide otherwise."""
    word = lambda i: f"w{i}q"
    plain = [word(i) for i in range(400)]
    passage = plain[:60]
    texts = [
        " ".join(passage + plain[100:300] + passage),  # the longest repeat is 60 words, and a third of all words
        " ".join(plain[:52] + plain[100:400] + plain[:52]),  # 52 words, 0.26 of the words
        " ".join(plain[300:348] + [word(i) for i in range(500, 700)] + plain[300:348]),  # 48 words, 0.32 of the words
        " ".join([word(i) for i in range(800, 1000)] + [word(i) for i in range(800, 820)]),  # stays
        " ".join([word(i) for i in range(1000, 2000)]),  # stays
        " ".join([word(i) for i in range(1000, 2000)] + ["more"]),  # a near copy of that
    ]
    rows = [(10**6 + i, t, "en", "planted", len(t)) for i, t in enumerate(texts)]
    return docs.unionByName(spark.createDataFrame(rows, docs.schema))


def test_stages_against_brute_force(spark, sf_dir, docs):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_dedup", "pii", "mixing", "packing"]
    docs = corpus_pipeline.saved(planted(spark, docs), "planted")
    steps = [docs]
    for name, stage in corpus_pipeline.STAGES:
        steps.append(corpus_pipeline.saved(stage(spark, steps[-1], sf_dir), name))
        if name != "packing":
            assert steps[-1].columns == docs.columns and steps[-1].dtypes == docs.dtypes
    before, good, single, private, mixed, packed = (s.collect() for s in steps)

    measured = measure([r.text for r in before], 8)
    fine = (measured.n_words >= 50) & (100 * measured.n_repeat_words <= 50 * measured.n_words) & (measured.covered_words <= 0.3 * measured.n_words) & (measured.longest_repeat <= 50)
    assert sorted(map(tuple, good)) == sorted(tuple(r) for r, k in zip(before, fine) if k)

    assert {r.doc_id for r in good if r.doc_id >= 10**6} == {10**6 + i for i in (3, 4, 5)}
    prints = {r.doc_id: brute_fingerprint(r.text) for r in good}
    groups = brute_groups(prints.values(), 2)
    least = {}
    for d, p in prints.items():
        least[groups[p]] = min(d, least.get(groups[p], d))
    assert sorted(map(tuple, single)) == sorted(tuple(r) for r in good if r.doc_id in set(least.values()))

    old = {r.doc_id: r for r in single}
    assert len(private) == len(single)
    for r in private:
        found = entities_of(old[r.doc_id].text)
        assert (r.text == old[r.doc_id].text) == (not found)
        assert (r.lang, r.source, r.n_chars) == (old[r.doc_id].lang, old[r.doc_id].source, len(r.text))
        for a, b, _, _ in found:
            assert old[r.doc_id].text[a:b] not in r.text

    copies, sizes, largest, taken = Counter(r.doc_id for r in mixed), Counter(), Counter(), Counter()
    for r in private:
        n = len(r.text.encode().split())
        sizes[r.source] += n
        largest[r.source] = max(largest[r.source], n)
        taken[r.source] += n * copies[r.doc_id]
    targets = brute_targets(sizes)
    for r in private:
        assert 0 <= copies[r.doc_id] - int(targets[r.source] / sizes[r.source] + 1e-9) <= 1 and copies[r.doc_id] <= 3
    assert all(abs(taken[s] - targets[s]) <= largest[s] / 2 + 1e-6 for s in sizes)
    texts = {r.doc_id: r.text for r in private}
    assert all(texts[r.doc_id] == r.text for r in mixed)

    want = expected([(r.doc_id, r.text) for r in mixed])
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in packed) == sorted(want)
    assert check_packing(packed) <= -(-sum(w[3] for w in want) // 2048) + 1


def test_edges(spark, edge, nothing):
    for docs, kept in ((edge, 1), (nothing, 0)):
        step = docs.drop("n_chars") if kept else docs
        for name, stage in corpus_pipeline.STAGES:
            columns = step.columns
            step = corpus_pipeline.saved(stage(spark, step, ""), name)
            if name == "packing":
                break
            assert step.columns == columns
            for r in step.collect():
                assert r.doc_id == 5 and {r[c] for c in columns if c not in ("doc_id", "text", "lang", "source", "n_chars")} == {"mine"}
        # of the small documents only the long one has words enough
        assert step.select("doc_id").distinct().count() == kept
