"""The registered queries over these operators; each reads whole tables and whole texts."""

from __future__ import annotations

from collections.abc import Callable
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.llm import chat, language, merkle, quality, sql, warc
from siltstone.llm.alignment import alignments
from siltstone.llm.binary_output import read_documents, sequence_folder, write_sequences
from siltstone.llm.common import settled, table
from siltstone.llm.fingerprints import edited_fingerprints
from siltstone.llm.mixing import mixed_sizes
from siltstone.llm.neighbours import nearest_neighbours
from siltstone.llm.packing import packed_documents
from siltstone.llm.simhash import near_duplicates
from siltstone.llm.token_counts import token_counts

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[function.__name__] = function
    return function


@query
def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every whole text; NULL and empty texts have none, repeated rows are counted each, an empty
    table gives no rows. Other columns are ignored."""
    return token_counts(table(spark, sf_dir, "documents"), "piece_bpe_32k.model", limit=4096)


@query
def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in sequences of 2048 tokens; NULL and empty texts are the end id alone, repeated rows
    are packed each, an empty table gives no rows."""
    return packed_documents(table(spark, sf_dir, "documents"), "word_bpe_49k.json", end=0, capacity=2048)


@query
def op8_binary_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids written to Arrow files in ascending order of doc_id (NULL first, ties by text) and read back; NULL
    and empty texts are the end id alone, an empty table gives no file and no rows."""
    documents = table(spark, sf_dir, "documents")
    manifest = write_sequences(documents, sequence_folder(spark), "word_bpe_49k.json", end=1)
    return read_documents(manifest)


@query
def op10_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of whole texts and the least id each is linked to; texts without words have fingerprint
    zero and are linked like any other, repeated rows share a component, an empty table gives no rows."""
    found = near_duplicates(table(spark, sf_dir, "documents"), shingle=4, distance=4)
    return found.select("doc_id", "fingerprint", "component_id")


@query
def op2_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sketches of each text and of its edited text, in the order of doc_id; NULL texts are empty, an empty
    table gives no rows."""
    return edited_fingerprints(table(spark, sf_dir, "documents"))


@query
def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A score per document from the labels of documents that are not held out; texts too short for n-grams
    score 0.5, without labels all do, an empty table gives no rows."""
    documents = table(spark, sf_dir, "documents")
    return quality.scored(documents, quality.train(documents, table(spark, sf_dir, "labels")))


@query
def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A language per document; ``und`` where the text is NULL or has no letter, or nothing was learned. An
    empty table gives no rows."""
    documents = table(spark, sf_dir, "documents")
    return language.identified(documents, language.train(documents))


@query
def op4_mixing_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of each document; NULL texts have size 0, NULL is a source of its own, repeated
    rows are taken each, an empty table gives no rows."""
    return mixed_sizes(table(spark, sf_dir, "documents"))


@query
def op7_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of conversations, read back from their windows; NULL roles and texts are empty, turns with one
    number are ordered by role and text. The probe conversation is always there."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat.digests(chat.formatted(turns.unionByName(chat.probe(turns))))


@query
def op5_approximate_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest of every hundredth vector; unusable vectors take no part, equal rows count once, an
    empty table gives no rows."""
    return nearest_neighbours(table(spark, sf_dir, "embeddings"), every=100, k=10)


@query
def op11_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents aligned between two tokenizers; NULL and empty texts have zeros and an empty digest,
    and an empty table gives no rows."""
    return alignments(table(spark, sf_dir, "documents"), "byte_bpe_50k.json", "piece_bpe_32k.model")


@query
def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written into WARC files and read back: NULL payloads are empty, repeated rows records of their
    own, and an empty table gives no rows."""
    folder = warc.archive_folder(spark)
    manifest = warc.write_archives(table(spark, sf_dir, "pages"), folder)
    return warc.resolved(settled(warc.read_records(manifest, folder), "warc-records"))


@query
def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as leaves, proved and checked again with every fifth text in lower case; NULL fields are
    leaves of ``-``, and an empty table gives no rows."""
    lowered = F.translate("text", ascii_uppercase, ascii_lowercase)
    when = F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % 5 == 0
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    return merkle.document_proofs(table(spark, sf_dir, "documents"), fields, {"text": lowered}, when)


ORACLES["op12_warc"] = sql.ARCHIVED_PAGES
ORACLES["op13_merkle_manifest"] = sql.document_manifest()
