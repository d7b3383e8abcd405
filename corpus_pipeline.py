"""The corpus pipeline: documents in, encoded documents out.

``STAGES`` lists ``(name, function)``; each function takes ``(spark, docs, sf_dir)`` and
returns a DataFrame. ``run`` applies them to ``documents`` one after the other; each stage's
result is written as Parquet in the shared scratch folder and read again as the next one's
``docs``, so that no stage is computed twice and a lost executor costs one stage at most.
All stages but the last return the columns of ``documents`` as they were.
"""

import public_tokenizers

from corpusflow.llm.bpe import encode_documents
from corpusflow.llm.common import stored
from corpusflow.llm.decontaminate import drop_leaks
from corpusflow.llm.exact_dedup import drop_copies
from corpusflow.llm.language_id import drop_unidentified, train
from corpusflow.llm.simhash import drop_near_copies
from corpusflow.session import prepare


#: What a worker remembers while encoding; less than by default, as it also holds other stages' memory.
REMEMBERED = 100_000


def language_id(spark, docs, sf_dir):
    """Drop documents in no language (null, empty and letterless texts)."""
    prepare(spark)
    return drop_unidentified(docs, train(docs))


def exact_dedup(spark, docs, sf_dir):
    """Of equal texts the row with the largest doc_id stays."""
    prepare(spark)
    return drop_copies(docs)


def simhash_dedup(spark, docs, sf_dir):
    """Of near copies (3 bits, 3-word shingles) the row with the smallest doc_id stays."""
    prepare(spark)
    return drop_near_copies(docs, shingle=3, radius=3)


def decontaminate(spark, docs, sf_dir):
    """Drop documents that leak at least 0.8 of a benchmark item in tiles of five words or more."""
    prepare(spark)
    return drop_leaks(docs, spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet"))


def byte_bpe(spark, docs, sf_dir):
    """Encode and decode what is left: doc_id, n_tokens and digests of the ids and bytes."""
    prepare(spark)
    return encode_documents(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, remembered=REMEMBERED, forget=True)


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_dedup),
    ("simhash_dedup", simhash_dedup),
    ("decontaminate", decontaminate),
    ("byte_bpe", byte_bpe),
]

#: No SQL expresses the language model, the fingerprints or the tokenizer; tests/llm holds
#: the stages against brute-force versions.
ORACLE_SQL = None


def run(spark, sf_dir):
    prepare(spark)
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES):
            docs = stored(docs, f"stage-{k}-{name}")
    return docs
