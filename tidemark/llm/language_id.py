"""Language ID by compression: the language whose zstandard raw-content dictionary makes a text smallest.

A dictionary is plain text of one language. Texts are lower-cased and cut into blocks, each compressed on its own with
every dictionary, so that a long text cannot outweigh the dictionary with its own repetitions.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window

from tidemark.llm.common import documents

UNKNOWN = "und"
# Put before each block: a short text alone would be stored as it is, as nothing is gained by compressing it.
CARRIER = b" " * 512


@dataclass(frozen=True)
class Settings:
    sample_docs: int = 1_000  # labelled documents per language that a dictionary is made of, at most
    sample_chars: int = 2_000  # characters of each that it takes, at most
    dictionary_bytes: int = 400_000  # size of a dictionary, at most
    block_chars: int = 1_000  # text compressed at once
    run_words: int = 3  # words of a run, compressed where whole blocks leave a narrow margin
    level: int = 6
    margin: float = 0.002  # the second smallest must be larger by this share of the smallest


def learn(labelled: DataFrame, settings: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> dict[str, bytes]:
    """One dictionary per language from a bounded sample of labelled rows, the rows with the lowest hashes.

    The sample is bounded by ``sample_docs`` and ``sample_chars`` for each language. Rows without language or text teach
    nothing; without any labelled row the result is empty. Languages are counted first, so that a language that holds
    most rows sends no more than the others; what reaches the driver grows with the number of languages only.
    """
    rows = documents(labelled, id_col, text_col, lang=lang_col).where("lang IS NOT NULL AND text <> ''")
    rows = rows.withColumn("lang", F.col("lang").cast("string"))
    counts = {r.lang: r["count"] for r in rows.groupBy("lang").count().collect()}
    hashed = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 40))
    rows = rows.select("lang", "doc_id", hashed.alias("hash"), F.substring("text", 1, settings.sample_chars).alias("text"))
    # Only hashes low enough for a few times the sample move at all; the exact lowest are picked among them.
    low = F.lit(None).cast("long")
    for lang, n in counts.items():
        low = F.when(F.col("lang") == lang, F.lit(int(min(1.0, 4 * settings.sample_docs / n) * (1 << 40)))).otherwise(low)
    order = Window.partitionBy("lang").orderBy("hash", "doc_id")
    sample = rows.where(F.col("hash") <= low).withColumn("place", F.row_number().over(order))
    sample = sample.where(F.col("place") <= settings.sample_docs)
    found: dict[str, list[str]] = {}
    for row in sample.select("lang", "place", "text").collect():
        found.setdefault(str(row.lang), []).append((row.place, row.text))
    return {
        lang: "\n".join(t for _, t in sorted(texts)).lower().encode()[-settings.dictionary_bytes:]
        for lang, texts in sorted(found.items())
    }


class Compressor:
    """Sizes of texts under each dictionary."""

    def __init__(self, dictionaries: dict[str, bytes], settings: Settings) -> None:
        import zstandard

        self.block, self.run, self.margin = settings.block_chars, settings.run_words, settings.margin
        self.tools = []
        for content in dictionaries.values():
            content = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            content.precompute_compress(level=settings.level)
            self.tools.append(zstandard.ZstdCompressor(
                level=settings.level, dict_data=content, write_content_size=False, write_checksum=False, write_dict_id=False,
            ))

    def total(self, parts: list[str]) -> list[int]:
        blocks = [CARRIER + p.encode() for p in parts]
        return [sum(len(tool.compress(b)) for b in blocks) for tool in self.tools]

    def sizes(self, text: str) -> list[int]:
        """Size of the whole text under each dictionary; where that leaves a narrow margin, runs of a few words count too."""
        text = text.lower()
        sizes = self.total([text[k:k + self.block] for k in range(0, len(text), self.block)])
        if len(sizes) > 1 and margin_of(sizes) < self.margin:
            words = text.split()
            runs = [" ".join(words[k:k + self.run]) for k in range(max(1, len(words) - self.run + 1))]
            sizes = [a + b for a, b in zip(sizes, self.total(runs), strict=True)]
        return sizes


def margin_of(sizes: list[int]) -> float:
    best, *rest = sorted(sizes)
    return rest[0] / best - 1 if rest else 0.0


def identify(
    docs: DataFrame, dictionaries: dict[str, bytes], settings: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """One row per input row: doc_id, lang_pred, score (0 to 1), margin, rejected.

    margin is how much larger the second smallest encoding is, as a share of the smallest; score grows with it.
    Rejected are margins below ``settings.margin`` and texts without a language. Null and empty texts and texts without
    a letter are ``und`` with score 0. Equal sizes go to the language that comes first by name. With one language only,
    or none, every margin is 0. Null ids stay null, repeated rows are each answered, further columns are not read, an
    empty table gives no rows. One narrow stage; the dictionaries, of bounded size, travel with the tasks.
    """
    rows = documents(docs, id_col, text_col)
    names = list(dictionaries)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compressor = Compressor(dictionaries, settings)
        for batch in batches:
            langs, margins = [], []
            for text, has_letter in zip(batch.column("text").to_pylist(), batch.column("has_letter").to_pylist(), strict=True):
                sizes = compressor.sizes(text) if has_letter and names else []
                if not sizes:
                    langs.append(UNKNOWN)
                    margins.append(0.0)
                    continue
                langs.append(names[sizes.index(min(sizes))])
                margins.append(margin_of(sizes))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(langs), pa.array(margins, pa.float64())], ["doc_id", "lang_pred", "margin"]
            )

    flagged = rows.withColumn("has_letter", F.col("text").rlike(r"\p{L}"))
    schema = rows.select("doc_id").schema.add("lang_pred", "string").add("margin", "double")
    found = flagged.mapInArrow(predict, schema)
    return found.select(
        "doc_id", "lang_pred", (1 - F.exp(-10 * F.col("margin"))).alias("score"), "margin",
        ((F.col("lang_pred") == UNKNOWN) | (F.col("margin") < settings.margin)).alias("rejected"),
    )
