"""The corpus pipeline: five stages over ``documents``, each written and read again before the next."""

import public_tokenizers

from basketlens.llm import bpe, linededup, minhash, mixing, quality
from basketlens.llm.common import cut, table

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def accept_quality(spark, docs, sf_dir):
    """Documents that the line field predicts good; the others go."""
    return quality.accepted(docs, table(spark, sf_dir, "labels"))


def remove_lines(spark, docs, sf_dir):
    """All documents, without lines that repeat an earlier one or come within two edits of it."""
    return linededup.deduplicated_lines(docs)


def keep_one_of_group(spark, docs, sf_dir):
    """Of documents with 80 % of five-word shingles in common, the one with the smallest doc_id."""
    return minhash.deduplicated(docs)


def mix_sources(spark, docs, sf_dir):
    """The mix: a row per document and epoch that takes words of it."""
    return mixing.mixed_documents(docs)


def encode_tokens(spark, docs, sf_dir):
    """doc_id, n_tokens and the digests of the ids and of the decoded text, per row of the mix."""
    return bpe.token_digests(docs, TOKENIZER)


STAGES = [
    ("quality", accept_quality),
    ("line_dedup", remove_lines),
    ("near_dedup", keep_one_of_group),
    ("mix", mix_sources),
    ("encode", encode_tokens),
]

# The field, the edit join, the components and the merges have no SQL form.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
