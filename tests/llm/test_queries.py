"""The pipeline as a whole on an awkward table, and the columns of the registered queries."""

import random

import pytest

import corpus_pipeline
from folio.llm import queries
from folio.llm.decontaminate import words

from . import cases

#: Columns and types that the contracts name.
COLUMNS = {
    "op1_decontaminate": {"doc_id": "bigint", "item_id": "bigint"},
    "op3_sharding": {"doc_id": "bigint", "size": "bigint", "text_crc32": "bigint", "law": "string", "shard": "int", "slot": "bigint",
                     "grown_shard": "int"},
    "op4_suffix_dedup": {"doc_id": "bigint", "n_bytes": "bigint", "n_removed": "bigint", "n_spans": "bigint", "kept_sha256": "string"},
    "op5_exact_dedup": {"doc_id": "bigint", "keep_id": "bigint", "group_size": "bigint", "kept": "boolean", "text_sha256": "string"},
    "op6_toxicity": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    "op7_jaccard_join": {"doc_id": "bigint", "n_shingles": "bigint", "component_id": "bigint"},
    "op8_pii": {"doc_id": "bigint", "n_email": "bigint", "n_ip": "bigint", "n_card": "bigint", "n_phone": "bigint",
                "base_sha256": "string", "spans": "string"},
    "op9_bpe": {"doc_id": "bigint", "n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"},
    "op11_line_dedup": {"doc_id": "bigint", "n_lines": "bigint", "n_dropped": "bigint", "kept_sha256": "string"},
}
ITEM = "the quick question of this test asks how many words an answer may have before it is cut"


def tables(spark, folder, rows):
    cases.frame(spark, rows).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, ITEM), (2, None)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    marks = [(i, 1, int(i % 3 == 0)) for i in range(300, 360)]
    spark.createDataFrame(marks, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return str(folder)


def rows_of_all_kinds():
    rng = random.Random(31)
    rows = cases.awkward()
    rows += [(200, "before it " + ITEM + " and after"), (201, cases.words_text(rng, 50) + " " + ITEM)]
    for i in range(300, 360):
        ws = cases.words_text(rng, 30).split()
        rows.append((i, " ".join(ws[:15] + ["scum", "idiot"] * (i % 3 == 0) + ws[15:])))
    return rows


def test_pipeline_on_awkward_documents(spark, tmp_path):
    """Stage by stage by hand on what the classifier keeps: exact copies, near copies, benchmark passages, token ids."""
    tokenizers, public = pytest.importorskip("tokenizers"), pytest.importorskip("public_tokenizers")
    rows = rows_of_all_kinds()
    folder = tables(spark, tmp_path, rows)
    got = corpus_pipeline.run(spark, folder).collect()
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = corpus_pipeline.drop_toxic(spark, docs, folder)
    assert kept.columns == docs.columns
    left = [(r["doc_id"], r["text"]) for r in kept.collect()]
    assert not [k for k, _ in left if k in range(300, 360) and k % 3 == 0] and len(left) == len(rows) - 20
    best = {}
    for k, t in left:
        squeezed = "".join(c for c in t or "" if c not in " \t\n\x0b\x0c\r")
        best.setdefault(squeezed, []).append((-len(t or ""), k is None, k or 0, t))
    left = [(None if x[1] else x[2], x[3]) for x in map(min, best.values())]
    _, group = cases.component_ids(left, 5, 80)
    first = {}
    for g, (k, t) in zip(group, left):
        first.setdefault(g, []).append((k is None, k or 0, t or ""))
    left = [(None if none else k, t) for none, k, t in map(min, first.values())]
    item = words(ITEM)
    left = [(k, t) for k, t in left if not any(words(t)[i:i + len(item)] == item for i in range(len(words(t))))]
    tokenizer = tokenizers.Tokenizer.from_file(public.path("word_bpe_49k.json"))
    tokenizer.no_truncation()
    tokenizer.no_padding()
    want = [(k, " ".join(map(str, tokenizer.encode(t, add_special_tokens=False).ids))) for k, t in left]
    order = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted(((r["doc_id"], r["ids"]) for r in got), key=order) == sorted(want, key=order)


def test_pipeline_decodes_the_token_ids(spark, tmp_path):
    tokenizers, public = pytest.importorskip("tokenizers"), pytest.importorskip("public_tokenizers")
    rows = [(1, "Two  Words, héllo 42!"), (2, None), (3, ""), (4, "see <|im_end|> it's"), (4, "of one id"), (None, "no id")]
    tokenizer = tokenizers.Tokenizer.from_file(public.path("word_bpe_49k.json"))
    tokenizer.no_truncation()
    tokenizer.no_padding()
    _, last = corpus_pipeline.STAGES[-1]
    got = last(spark, cases.frame(spark, rows), str(tmp_path)).collect()
    ids = [tokenizer.encode(t or "", add_special_tokens=False).ids for _, t in rows]
    want = [(k, len(i), " ".join(map(str, i)), tokenizer.decode(i, skip_special_tokens=False)) for (k, _), i in zip(rows, ids)]
    order = lambda r: (r[0] is None, r[0] or 0, r[2])
    assert sorted(((r["doc_id"], r["n_tokens"], r["ids"], r["decoded"]) for r in got), key=order) == sorted(want, key=order)


def test_queries_have_the_columns_of_their_contracts(spark, tmp_path):
    folder = tables(spark, tmp_path, rows_of_all_kinds()[-20:])
    for name, columns in COLUMNS.items():
        types = dict(queries.QUERIES[name](spark, folder).dtypes)
        assert {c: types.get(c) for c in columns} == columns, name
