"""Language identification by compression.

Each language has a raw-content dictionary of sample text. A text (its words in lower case, without
ASCII punctuation and digits) is compressed once with every dictionary, in blocks short enough that the dictionary and not the text itself decides, and the
language with the smallest total wins. ``rejected`` marks texts without letters and those where
the second best language comes too close.

Learning takes a bounded sample: of each language the text with the smallest hash in each of
``PIECES`` hash classes of ids, ``PIECE_BYTES`` characters of it from a place that the hash chooses. Every
labelled row is looked at, and the dictionaries stay ``PIECES * PIECE_BYTES`` characters a language at any input size.

Defined results: null text, empty text and text without a letter are ``und`` with score 0 and are
rejected; with no learned language every text is; a null id counts as the empty string in hashes;
equal sizes go to the language with more learned rows; each input row gives one output row, repeated or not.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, functions as F

from strata.llm.blocks import slices, table_path, utf8

PIECES = 128
PIECE_BYTES = 1024
BLOCK = 2048
LEVEL = 5
MIN_MARGIN = 0.002  # of the best size; below it the text is rejected


NOT_LETTERS = bytes(32 if i < 128 and not chr(i).isalpha() else i for i in range(256))


def plain(text: str) -> bytes:
    """Lower-case words with one blank between them, without the punctuation and digits of ASCII."""
    return b" ".join(text.lower().encode().translate(NOT_LETTERS).split())


def crc_class(id_column: str, classes: int) -> Column:
    """crc32 of the id as text, modulo ``classes``; a null id counts as the empty string."""
    return F.crc32(F.coalesce(F.col(id_column).cast("string"), F.lit("")).cast("binary")) % classes


def learn_dictionaries(
    df: DataFrame, lang: str = "lang", text: str = "text", doc_id: str = "doc_id",
    pieces: int = PIECES, piece_bytes: int = PIECE_BYTES,
) -> dict[str, bytes]:
    """Sample text of every language in the labelled rows, the most frequent language first.

    The aggregate keeps one piece per language and hash class from the start, so nothing larger
    than the sample is shuffled or reaches the driver.
    """
    chance = F.xxhash64(F.col(doc_id).cast("string"), F.lit(10))
    # the hash's upper bits, which its class does not depend on, choose where the piece begins
    places = F.greatest(F.length(text) - piece_bytes + 1, F.lit(1))
    begin = (F.pmod(F.shiftright(chance, 16), places) + 1).cast("int")
    sample = (
        df.where(F.col(lang).isNotNull() & F.col(text).rlike(r"\p{L}"))
        .select(
            F.col(lang).alias("lang"), F.pmod(chance, F.lit(pieces)).alias("class"),
            F.struct(chance.alias("chance"), F.substring(F.col(text), begin, F.lit(piece_bytes)).alias("piece")).alias("row"),
        )
        .groupBy("lang", "class").agg(F.min("row").alias("row"), F.count("*").alias("n"))
        .select("lang", "class", "row.piece", "n")
    )
    found: dict[str, list[bytes]] = {}
    rows: Counter[str] = Counter()
    for row in sorted(sample.collect()):
        found.setdefault(row["lang"], []).append(plain(row["piece"]))
        rows[row["lang"]] += row["n"]
    return {language: b"\n".join(found[language]) for language in sorted(found, key=lambda x: (-rows[x], x))}


def identify(
    df: DataFrame, dictionaries: dict[str, bytes], text: str = "text", keep: tuple[str, ...] = ("doc_id",),
    min_margin: float = MIN_MARGIN,
) -> DataFrame:
    """``keep``, ``lang_pred``, ``score``, ``margin`` and ``rejected`` of every whole text.

    ``score`` is the winner's share when each language weighs 2 to the power of minus its bits;
    ``margin`` is how much larger the second best size is, relative to the best.
    """
    languages = list(dictionaries)
    shared = df.sparkSession.sparkContext.broadcast(dictionaries)
    kept = df.select(*keep).schema
    schema = kept.add("lang_pred", "string").add("score", "double").add("margin", "double").add("rejected", "boolean")
    source = df.select(*keep, utf8(text).alias("__text"), F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False)).alias("__letters"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compressors = []
        for content in shared.value.values():
            raw = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            raw.precompute_compress(level=LEVEL)
            compressors.append(zstandard.ZstdCompressor(
                level=LEVEL, dict_data=raw, write_content_size=False, write_checksum=False, write_dict_id=False,
            ))

        def result(text: bytes, letters: bool):
            body = plain(text.decode("utf-8", "replace"))
            if not body or not letters or not compressors:
                return "und", 0.0, 0.0, True
            view = memoryview(body)
            blocks = [view[i : i + BLOCK] for i in range(0, len(body), BLOCK)]
            sizes = np.array([sum(len(c.compress(b)) for b in blocks) for c in compressors], np.float64)
            best = int(sizes.argmin())
            score = 1.0 / np.exp2(np.maximum(8.0 * (sizes[best] - sizes), -1000.0)).sum()
            margin = float(np.partition(sizes, 1)[1] / sizes[best] - 1.0) if len(sizes) > 1 else 1.0
            return languages[best], float(score), margin, margin < min_margin

        for batch in slices(batches, "__text"):
            rows = [result(b.as_buffer().to_pybytes(), ok.as_py()) for b, ok in zip(batch["__text"], batch["__letters"])]
            yield pa.RecordBatch.from_arrays(
                [*(batch[name] for name in keep), *(pa.array(x, t) for x, t in zip(
                    zip(*rows), (pa.string(), pa.float64(), pa.float64(), pa.bool_())))],
                [f.name for f in schema],
            )

    return source.mapInArrow(run, schema)


def op10_language_id(spark, sf_dir: str) -> DataFrame:
    """Predict the language of every whole text; rows whose id's crc32 is 0 modulo 5 are held out."""
    documents = spark.read.parquet(table_path(sf_dir, "documents"))
    dictionaries = learn_dictionaries(documents.where(crc_class("doc_id", 5) != 0))
    found = identify(documents, dictionaries)
    return found.select("doc_id", (crc_class("doc_id", 5) == 0).alias("held_out"), "lang_pred", "score", "margin", "rejected")


QUERIES = {"op10_language_id": (op10_language_id, None)}
