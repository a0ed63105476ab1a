"""Token counts through a digest cache.

A cache table maps (tokenizer digest, content digest) to a token count. Counting joins the digests
of the documents to it, encodes only distinct contents that it lacks, and appends those.
"""

from __future__ import annotations

import hashlib
import json
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorloom.llm.common import content, join_spread, map_batches, written

#: tiktoken's pattern fails on about a million white-space characters in a row; such runs, from
#: far below, go to tokenizers.
LONG_SPACES = 100_000
_LONG_SPACES = re.compile(rf"\s{{{LONG_SPACES}}}")
CACHE = "tokenizer string, digest binary, n_tokens long"


def tokenizer_digest(path: str) -> str:
    """Version of a tokenizer: the digest of its file."""
    with open(path, "rb") as file:
        return hashlib.sha256(file.read()).hexdigest()


class Encoder:
    """Token ids of whole texts, as the file's own library gives them.

    A plain byte-level BPE file is run by tiktoken over the file's vocabulary: the merges of such a
    file stand in the order of their ids, so both libraries give the same ids, four times faster.
    A text with a very long run of white space, or one that tiktoken fails on, goes to tokenizers.
    Any other .json goes to tokenizers, any .model to sentencepiece. No begin, end or added special
    tokens, no truncation, no padding; special strings in a text are read as the library does.
    """

    def __init__(self, path: str) -> None:
        self.pieces = self.library = self.fast = None
        if path.endswith(".model"):
            import sentencepiece

            self.pieces = sentencepiece.SentencePieceProcessor(model_file=path)
            return
        self.path = path
        with open(path, encoding="utf-8") as file:
            self.fast = _byte_level(json.load(file))
        if self.fast is None:
            self.library = self._whole()

    def _whole(self):
        """The file in its own library, made when first needed."""
        if self.library is None:
            from tokenizers import Tokenizer

            self.library = Tokenizer.from_file(self.path)
            self.library.no_truncation()
            self.library.no_padding()
        return self.library

    def _one(self, text: str) -> np.ndarray:
        if len(text) < LONG_SPACES or not _LONG_SPACES.search(text):
            try:
                return self.fast.encode_to_numpy(text, allowed_special="all")
            except Exception as error:
                if "Regex error" not in str(error):
                    raise
        return np.array(self._whole().encode(text, add_special_tokens=False).ids, np.uint32)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        if self.fast is not None:
            return [self._one(x) for x in texts]
        if self.pieces is not None:
            return [np.array(x, np.uint32) for x in self.pieces.encode(texts, num_threads=1)]
        made = self.library.encode_batch(texts, add_special_tokens=False)
        return [np.array(x.ids, np.uint32) for x in made]


def _byte_level(spec: dict):
    """A tiktoken encoding equal to the given file, or None where equality isn't certain."""
    model, split = spec["model"], spec.get("pre_tokenizer") or {}
    plain = (
        model.get("type") == "BPE"
        and split.get("type") == "ByteLevel"
        and split.get("use_regex", True)
        and not split.get("add_prefix_space")
        and not any(spec.get(k) for k in ("normalizer", "truncation", "padding"))
        and not any(
            model.get(k)
            for k in (
                "dropout",
                "unk_token",
                "continuing_subword_prefix",
                "end_of_word_suffix",
                "ignore_merges",
            )
        )
        and not any(
            t[k] for t in spec["added_tokens"] for k in ("lstrip", "rstrip", "single_word")
        )
    )
    if not plain:
        return None
    import tiktoken

    letters = {letter: byte for byte, letter in _byte_letters().items()}
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    merged = ["".join(m) if isinstance(m, list) else m.replace(" ", "") for m in model["merges"]]
    ids = [model["vocab"][m] for m in merged]
    if ids != sorted(set(ids)):
        return None
    ranks = {
        bytes(letters[c] for c in token): i
        for token, i in model["vocab"].items()
        if token not in special
    }
    # The split of the byte-level pre-tokenizer: a fixed pattern of the file format.
    pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
    return tiktoken.Encoding(
        "file", pat_str=pattern, mergeable_ranks=ranks, special_tokens=special
    )


def _byte_letters() -> dict[int, str]:
    """How byte-level files write bytes: printable ones as they are, the others from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}


@lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    """One encoder for each Python worker and file."""
    return Encoder(path)


def read_cache(spark: SparkSession, path: str, version: str) -> DataFrame:
    """Stored counts of one tokenizer version, one row for each content digest.

    A job that failed after its append may have stored a digest twice; both counts are equal.
    """
    try:
        stored = spark.read.schema(CACHE).parquet(path)
    except Exception as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return spark.createDataFrame([], "digest binary, n_tokens long")
    stored = stored.where(F.col("tokenizer") == version)
    return stored.groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))


def count_tokens(
    docs: DataFrame, tokenizer: str, cache: str, *, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row for each row of ``docs``: its key, n_bytes, content digest and n_tokens.

    ``cache`` is a Parquet folder that all executors reach; it is created when missing, read, and
    appended to. Content is the text with null as empty; nothing else may be normalised away,
    because white space and case are tokens too. A null or repeated key stays as it is, empty
    tables give empty results, other columns of ``docs`` are not read. A very long text is encoded whole,
    by the task that has its row. Copies of a content collapse
    in each map task before the shuffle, so a hot one reaches its task once for each of those.
    """
    spark = docs.sparkSession
    version = tokenizer_digest(tokenizer)
    whole = content(text)
    digest = F.unhex(F.sha2(whole, 256)).alias("digest")
    stored = read_cache(spark, cache, version)
    distinct = docs.select(digest, whole.alias("content")).groupBy("digest")
    misses = distinct.agg(F.first("content").alias("content")).join(stored, "digest", "left_anti")

    def encode(batch: pa.RecordBatch) -> pa.RecordBatch:
        counts = [len(x) for x in encoder(tokenizer).encode(batch.column("content").to_pylist())]
        return pa.RecordBatch.from_arrays(
            [pa.array([version] * len(counts)), batch.column("digest"), pa.array(counts, pa.int64())],
            names=["tokenizer", "digest", "n_tokens"],
        )

    map_batches(misses, encode, CACHE).write.mode("append").parquet(cache)
    keyed = docs.select(F.col(key).alias("_key"), F.octet_length(whole).cast("long").alias("n_bytes"), digest)
    counts = read_cache(spark, cache, version)
    made = join_spread(written(keyed, "keyed"), counts, ["digest"], F.xxhash64("_key"))
    return made.withColumnRenamed("_key", key)
