"""The operators as queries over whole tables: ``name -> (spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import grade_model, hard_negatives, huffman, jaccard_join, line_dedup, mixing, packing, passages, quality_rules, run_detection, sketch_join, suffix_dedup, topk_search
from millrace.llm.common import batch_of, raw_bytes, table
from millrace.llm.tokens import crc_of, id_type, token_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(build):
    QUERIES[build.__name__] = build
    return build


@query
def op1_line_dedup(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    marked = line_dedup.with_bitmaps(docs).select("doc_id", raw_bytes().alias("t"), "_bitmap")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [line_dedup.cut(t, b) for t, b in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
            yield pa.RecordBatch.from_pydict(
                {"doc_id": batch.column(0), "n_lines": [r[1] for r in rows], "n_dropped": [r[2] for r in rows],
                 "kept_sha256": [hashlib.sha256(r[0]).hexdigest() for r in rows]}
            )

    return marked.mapInArrow(run, "doc_id long, n_lines long, n_dropped long, kept_sha256 string")


@query
def op8_quality_rules(spark, sf):
    return quality_rules.measure(table(spark, sf, "documents"))


@query
def op10_jaccard_join(spark, sf):
    return jaccard_join.components(table(spark, sf, "documents"))


@query
def op5_packing(spark, sf):
    return packed(table(spark, sf, "documents"))


def packed(docs: DataFrame, path: str | None = None, end_id: int = 2) -> DataFrame:
    """Pieces of all documents with the checksum of their ids."""
    path = path or public_tokenizers.path("word_bpe_49k.json")
    tokens, dtype = token_table(docs, path, end_id), id_type(path)
    pieces = packing.pack(tokens).groupBy("part", "seq").agg(
        F.collect_list(F.struct("start", "length", "sequence_id", "offset")).alias("pieces")
    )
    rows = tokens.join(pieces, ["part", "seq"]).select("doc_id", "n_tokens", "ids", "pieces")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc, n, raw, cuts in zip(*(c.to_pylist() for c in batch.columns)):
                ids = np.frombuffer(raw, dtype)
                for p in sorted(cuts, key=lambda p: p["start"]):
                    a, b = p["start"], p["start"] + p["length"]
                    out.append((doc, a, b - a, crc_of(ids[a:b]), n, p["sequence_id"], p["offset"]))
            yield batch_of(PIECES, dict(zip(PIECES.names, zip(*out)))) if out else PIECES.empty_table().to_batches()[0]

    return rows.mapInArrow(run, ", ".join(f"{n} long" for n in PIECES.names))


PIECES = pa.schema(
    [(n, pa.int64()) for n in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")]
)


@query
def op6_token_files(spark, sf):
    path = public_tokenizers.path("byte_bpe_50k.json")
    tokens = token_table(table(spark, sf, "documents"), path, end_id=0)
    return huffman.read_ids(huffman.write_ids(tokens, id_type(path)))


@query
def op7_mixing(spark, sf):
    rows = mixing.weigh(table(spark, sf, "documents"))
    return rows.select("doc_id", "source", "lang", "mix_topic", "mix_tokens", "mix_probability", "mix_kept")


@query
def op2_topk_search(spark, sf):
    return topk_search.top_k(table(spark, sf, "embeddings"), F.col("vec_id") % 100 == 0)


@query
def op9_grade_model(spark, sf):
    docs = table(spark, sf, "documents")
    return grade_model.score(docs, grade_model.train(docs, table(spark, sf, "labels")))


@query
def op3_suffix_dedup(spark, sf):
    cut = suffix_dedup.remove_repeats(table(spark, sf, "documents"))
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op4_passages(spark, sf):
    return passages.near_passages(table(spark, sf, "documents"))


@query
def op11_minhash_dedup(spark, sf):
    return sketch_join.components(table(spark, sf, "documents"))


@query
def op12_periodic_runs(spark, sf):
    found = run_detection.find_runs(with_planted_runs(table(spark, sf, "documents")))
    best = F.col("strongest")
    lines = F.transform("runs", lambda r: F.format_string("%d,%d,%d\n", r["start"], r["length"], r["period"]))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), best["start"].alias("start"), best["length"].alias("length"),
        best["period"].alias("period"), F.expr("1000 * strongest.length div strongest.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """``doc_id, text``; in a tenth of the documents, by a checksum of doc_id, the words repeat from some word on."""
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).withColumn(
        "h", F.crc32(F.col("doc_id").cast("string").cast("binary"))
    )
    chosen, words = F.col("h") % 10 == 0, F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    rows = rows.withColumn("w", F.when(chosen, words)).withColumn("n", F.greatest(F.size("w"), F.lit(1)).cast("long"))
    rows = rows.withColumn("a", F.expr("(h div 10) % n")).withColumn("p", F.expr("1 + (n - a) div (3 + (h div 10) % 8)"))
    place = F.sequence(F.lit(0), F.col("n") - 1)
    source = F.transform(place, lambda i: F.when(i < F.col("a"), i).otherwise(F.col("a") + F.try_mod(i - F.col("a"), F.col("p"))))
    planted = F.array_join(F.transform(source, lambda i: F.get("w", i.cast("int"))), " ")
    return rows.select("doc_id", F.when(chosen, planted).otherwise(F.col("text")).alias("text"))


@query
def op13_hard_negatives(spark, sf):
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(table(spark, sf, "embeddings"), F.col("vec_id") % 100 == 0, label)
