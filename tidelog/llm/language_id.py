"""Language ID by compression against per-language dictionaries.

Each language gets a few raw-content zstandard dictionaries, cut from a bounded
sample of its labelled texts. A text is normalised (lower case, one space for
each run of other characters), encoded in chunks with every dictionary, and goes
to the language whose encoding is the shortest. The score is how far the second
shortest lies above it, as a share; `accepted` is false where that margin is
narrow. Short texts are encoded with all dictionaries of a language, since single
encodings have whole bytes and often tie.

Training reads all labels and counts them, then takes texts by the hash of their
id with a share that makes the sample bounded: `SAMPLE_DOCS` texts of up to
`SAMPLE_CHARS` characters for a language, whatever the corpus holds. Prediction
is one pass over whole texts without a shuffle.

Defined results: a null text, or one without any letter, is `und` with score 0
and not accepted; exact ties go to the first language in alphabetical order with
score 0; without labelled texts every text is `und`; repeated rows are predicted
alike; columns with names of the results are replaced, others pass through.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StringType, StructField, StructType

from tidelog.llm.common import registered, table

UNDETERMINED = "und"
#: Fitting bounds: texts sampled for a language, characters used of each.
SAMPLE_DOCS = 400
SAMPLE_CHARS = 400
MAX_LANGUAGES = 1000
DICTIONARIES = 4
DICTIONARY_BYTES = 16 * 1024
CHUNK = 2048
#: Rows of a batch that are Python strings, and on their way back, at once.
SLICE = 128
LEVEL = 6
MIN_MARGIN = 0.003

NOT_LETTERS = re.compile(r"[\W\d_]+")
RESULTS = ["lang_pred", "score", "accepted"]


def normalised(text: str) -> bytes:
    text = text.lower()
    if not text.isascii():
        # numbers that are no decimal digits, like ½, which `\w` counts as parts of words
        for char in set(text):
            if char.isnumeric() and not char.isalpha() and not char.isdecimal():
                text = text.replace(char, " ")
    return NOT_LETTERS.sub(" ", text).strip().encode("utf-8", "replace")


def fit(labelled: DataFrame) -> dict[str, list[bytes]]:
    """Dictionaries of each language from rows (doc_id, text, lang)."""
    rows = labelled.where("text IS NOT NULL AND lang IS NOT NULL")
    counts = rows.groupBy("lang").count().limit(MAX_LANGUAGES + 1).collect()
    if len(counts) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    if not counts:
        return {}
    # the share of a language's texts, in parts of a million, that the sample takes
    shares = {r["lang"]: max(1, math.ceil(1e6 * min(1.0, SAMPLE_DOCS / r["count"]))) for r in counts}
    share = F.create_map(*(F.lit(x) for pair in shares.items() for x in pair))
    sample = (
        rows.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(1_000_000)) < share[F.col("lang")])
        .select("lang", F.xxhash64("doc_id", "text").alias("h"), F.substring("text", 1, SAMPLE_CHARS).alias("text"))
        .orderBy("h", "lang", "text")
        .limit(2 * SAMPLE_DOCS * len(shares))
        .collect()
    )
    texts = defaultdict(list)
    for row in sample:
        if len(texts[row["lang"]]) < SAMPLE_DOCS:
            texts[row["lang"]].append(normalised(row["text"]))
    return {
        lang: [b" ".join(own[k::DICTIONARIES])[:DICTIONARY_BYTES] for k in range(DICTIONARIES)]
        for lang, own in sorted(texts.items())
    }


def compressors(dictionaries: dict[str, list[bytes]]):
    """Per language, an encoder for each of its dictionaries."""
    settings = zstandard.ZstdCompressionParameters.from_level(
        LEVEL, source_size=CHUNK, dict_size=DICTIONARY_BYTES, write_content_size=0, write_checksum=0
    )
    made = {}
    for lang, parts in dictionaries.items():
        made[lang] = []
        for part in parts:
            words = zstandard.ZstdCompressionDict(
                part.ljust(16), dict_type=zstandard.DICT_TYPE_RAWCONTENT
            )
            words.precompute_compress(compression_params=settings)
            made[lang].append(zstandard.ZstdCompressor(dict_data=words, compression_params=settings))
    return made


def classify(text: str | None, made) -> tuple[str, float]:
    plain = normalised(text or "")
    if not plain or not made:
        return UNDETERMINED, 0.0
    chunks = [plain[i : i + CHUNK] for i in range(0, len(plain), CHUNK)]
    used = max(1, min(DICTIONARIES, 2 * CHUNK // len(plain)))
    sizes = sorted(
        (sum(len(one.compress(c)) for one in own[:used] for c in chunks), lang) for lang, own in made.items()
    )
    if len(sizes) == 1:
        return sizes[0][1], 1.0
    return sizes[0][1], (sizes[1][0] - sizes[0][0]) / sizes[1][0]


def identify(docs: DataFrame, dictionaries: dict[str, list[bytes]], min_margin: float = MIN_MARGIN) -> DataFrame:
    """`docs` with lang_pred, score and accepted; only `text` is looked at."""
    kept = [f for f in docs.schema.fields if f.name not in RESULTS]
    schema = StructType(
        [
            *kept,
            StructField("lang_pred", StringType()),
            StructField("score", DoubleType()),
            StructField("accepted", BooleanType()),
        ]
    )

    names = [f.name for f in schema]

    def predict(batches):
        made = compressors(dictionaries)
        for batch in batches:
            # the other columns go back as they came
            for start in range(0, batch.num_rows, SLICE):
                part = batch.slice(start, SLICE)
                found = [classify(text, made) for text in part.column("text").to_pylist()]
                results = [
                    pa.array([lang for lang, _ in found], pa.string()),
                    pa.array([score for _, score in found], pa.float64()),
                    pa.array([lang != UNDETERMINED and score >= min_margin for lang, score in found], pa.bool_()),
                ]
                yield pa.RecordBatch.from_arrays([*part.columns, *results], names=names)

    return docs.select(*(f.name for f in kept)).mapInArrow(predict, schema)


def held_out():
    """True for documents that training leaves aside."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))


@registered("op2_language_id")
def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    dictionaries = fit(docs.where(~held_out()))
    predicted = identify(docs.select("doc_id", "text", held_out().alias("held_out")), dictionaries)
    return predicted.select("doc_id", "held_out", "lang_pred", "score", "accepted")
