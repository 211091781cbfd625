"""From raw documents to packed sequences: each stage works on all rows that the one before has kept.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and
read again as the next one's docs. All but the last return the columns of ``documents``. What a stage has left in the shared folder is
deleted when a later one begins, as its output is written by then; if it isn't, what it reads stays.

Every stage takes nulls in any column, empty and very long texts, ties, repeated rows, empty tables and further columns, which go through:
see each function.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tilewright.llm import order_minhash, packing, quality_rules, secret_scan
from tilewright.workspace import Workspace, opened

#: The end id of a packed document and the length of a sequence.
END_ID, CAPACITY = 0, 1024


#: Workspaces whose tables the output of the last stage is made from.
_left: list[Workspace] = []


def _stage(make: Callable[[DataFrame], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    """``make`` as a stage: deletes what the stages before have left, and notes what this one leaves."""

    def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        read = docs.inputFiles()
        for ws in [*_left]:
            if not any(ws.root in file for file in read):  # docs that aren't written yet still need it
                ws.close()
                _left.remove(ws)
        with opened() as made:
            out = make(docs)
        _left.extend(made)
        return out

    stage.__name__, stage.__doc__ = make.__name__, make.__doc__
    return stage


@_stage
def quality(docs: DataFrame) -> DataFrame:
    """Documents that pass the base rules and lie within the fences of their language and source.

    Null, empty and blank texts go, as they have no words. A null language or source is a group like others. Repeated rows are judged alike and
    each stays; a value on a fence stays. Texts are measured whole. An empty table stays empty.
    """
    return quality_rules.keep_good(docs)


@_stage
def near_dedup(docs: DataFrame) -> DataFrame:
    """Of each group of copies and near copies, the document with the smallest id.

    Null, empty and wordless texts are copies of nothing and stay, as do rows with a null id. Repeated rows stay once; of unlike texts with
    one id all stay. Texts are compared whole. An empty table stays empty.
    """
    return order_minhash.keep_one(docs)


@_stage
def secrets(docs: DataFrame) -> DataFrame:
    """All documents, with every secret replaced by a mark and ``n_chars`` brought up to date.

    Null stays null and empty stays empty; overlapping finds are one mark. Texts are scanned whole; repeated rows each come back.
    """
    return secret_scan.redact_secrets(docs, length="n_chars")


@_stage
def pack(docs: DataFrame) -> DataFrame:
    """Where each piece of each document lies in the packed sequences.

    Null and empty texts are the end id alone; a long text is cut into full sequences and a tail; repeated rows are packed each; a null id goes
    through. An empty table gives an empty one.
    """
    return packing.pack(docs, ["doc_id"], public_tokenizers.path("byte_bpe_50k.json"), END_ID, CAPACITY)


STAGES = [("quality", quality), ("near_dedup", near_dedup), ("secrets", secrets), ("pack", pack)]

#: Sketch candidates, lexing and tokenising have no SQL form; tests/llm compares each stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    ws, docs = Workspace(spark, "pipeline"), spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = ws.save(stage(spark, docs, sf_dir), name)
        if k:
            ws.drop(STAGES[k - 1][0])
    return docs
