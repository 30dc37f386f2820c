"""Writing a smaller corpus with labels that refer only to it."""

from __future__ import annotations

from pyspark.sql import SparkSession

from docquarry.operators.sampling import documents_up_to, first_documents, labels_up_to
from docquarry.sources.tables import read_table, write_table


def reduce_tables(
    spark: SparkSession,
    corpus_path: str,
    label_paths: list[str],
    out_paths: list[str],
    cutoff: int,
    by: str = "id",
) -> None:
    """Corpus and labels cut at one ``cutoff``, written to new paths.

    ``by="id"`` keeps documents with an id up to the cut-off, ``by="rows"`` the
    first ``cutoff`` documents in id order. ``out_paths`` has one path for the
    corpus, then one per label table; none may be an input.
    """
    if set(out_paths) & {corpus_path, *label_paths}:
        raise ValueError("a reduced table must not replace a table being read")
    if len(out_paths) != 1 + len(label_paths):
        raise ValueError("one output path per table is needed")
    pick = {"id": documents_up_to, "rows": first_documents}[by]
    write_table(pick(read_table(spark, corpus_path), cutoff), out_paths[0])
    for source, target in zip(label_paths, out_paths[1:]):
        write_table(labels_up_to(read_table(spark, source), cutoff), target)
