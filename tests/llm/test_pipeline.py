import hashlib
import math
import re
from collections import Counter, defaultdict

import sentencepiece

import corpus_pipeline
from surgeline.llm.queries import piece_model
from tests_llm_brute import brute_classes, water


def brute_pipeline(rows):
    """The same stages on plain lists."""
    rows = [r for r in rows if any(c.isalpha() for c in r.text or "")]
    order = lambda r: (r.doc_id is None, r.doc_id or 0)
    groups = defaultdict(list)
    for r in rows:
        groups[re.sub(r"[\x20\x09-\x0D]", "", r.text)].append(r)
    rows = [min(g, key=lambda r: (-len(r.text), *order(r))) for g in groups.values()]
    classes = brute_classes([r.text for r in rows])
    rows = [min((r for r, c in zip(rows, classes) if c == k), key=order) for k in sorted(set(classes))]
    size = lambda r: len(re.findall(r"[^\x20\x09-\x0D]+", r.text))
    names = sorted({r.source for r in rows}, key=lambda s: (s is None, s or ""))
    sizes = [sum(size(r) for r in rows if r.source == s) for s in names]
    out = []
    library = sentencepiece.SentencePieceProcessor(model_file=piece_model())
    for s, total, target in zip(names, sizes, water(sizes, [i % 3 + 1 for i in range(len(names))])):
        whole = math.floor(round(target, 6) / total)
        rest = math.floor(round(target, 6) - whole * total + 0.5)
        for r in sorted((r for r in rows if r.source == s), key=lambda r: hashlib.md5(f"20260:{'' if r.doc_id is None else r.doc_id}".encode()).hexdigest()):
            part = max(0, min(size(r), rest))
            rest -= part
            ids = library.encode(r.text)
            row = (r.doc_id, s, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(library.decode(ids).encode()).hexdigest())
            out += [row] * (whole + (part > 0 and 2 * part >= size(r)))
    return Counter(out)


def test_pipeline_against_brute_force(spark, docs, tmp_path):
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    got = corpus_pipeline.run(spark, str(tmp_path)).select("doc_id", "source", "n_tokens", "ids_sha256", "decoded_sha256").collect()
    assert Counter(tuple(r) for r in got) == brute_pipeline(docs.collect())


def test_stages_keep_the_columns_and_take_odd_tables(spark, docs, none, clashing):
    for df in (none, clashing.limit(12)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, df, "")
            assert out.columns == df.columns, name
            assert (out.count() == 0) == (df is none)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "exact_dedup", "near_dedup", "mix", "tokens"]
    no_language = docs.withColumn("lang", docs["source"].cast("string")).drop("lang").selectExpr("doc_id", "text", "cast(null as string) as lang", "source", "n_chars")
    kept = {r.doc_id for r in corpus_pipeline.language(spark, no_language, "").collect()}
    assert {4, 5, 6, 7}.isdisjoint(kept) and {1, 8, 10} <= kept
