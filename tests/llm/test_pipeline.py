"""The pipeline against a plain version of its stages, and the registered queries."""

import __spark_entry__ as entry
import corpus_pipeline
from regspark.llm.decontaminate import normalise, substring_distance
from regspark.llm.pii import Crf, all_spans, redact

SF = "/root/testdata/sf0.001"


def test_every_operator_is_registered():
    names = entry.queries()
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11)) and "pipeline" in names


def test_stages_match_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = {r.doc_id: r for r in docs.collect()}
    stages = dict(corpus_pipeline.STAGES)

    kept = stages["language_id"](spark, docs, SF)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == set(rows)

    sets = {}
    for i, r in rows.items():
        w = r.text.encode().lower().split()
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))}
    comp = {i: i for i in sets}
    for a in sorted(sets):
        for b in sorted(sets):
            if a < b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                lo, hi = sorted((comp[a], comp[b]))
                comp = {i: lo if c == hi else c for i, c in comp.items()}
    deduped = stages["near_dedup"](spark, docs, SF)
    assert {r.doc_id for r in deduped.collect()} == {i for i, c in comp.items() if c == i}

    items = [normalise(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    leaked = {i for i, r in rows.items() if any(x in normalise(r.text) for x in items)}
    clean = {r.doc_id for r in stages["decontamination"](spark, docs, SF).collect()}
    assert not clean & leaked
    for i in set(rows) - clean - leaked:
        text = normalise(rows[i].text)
        assert min(substring_distance(x, text) / len(x) for x in items) <= 0.06

    crf = Crf()
    for r in stages["personal_data"](spark, docs, SF).collect():
        want = redact(rows[r.doc_id].text, all_spans(crf, rows[r.doc_id].text, {})[1])
        assert (r.text, r.n_chars, r.source) == (want, len(want), rows[r.doc_id].source)


def test_run_gives_pieces_of_the_kept_documents(spark):
    out = corpus_pipeline.run(spark, SF)
    rows = out.collect()
    by_doc = {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
    assert all(sum(p.length for p in v) == v[0].doc_tokens for v in by_doc.values())
    assert 0 < len(by_doc) < 200
