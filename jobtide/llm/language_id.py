"""Language identification by compression.

Each language has a zstandard dictionary of raw text. A text is compressed with every dictionary;
the language whose dictionary makes it smallest is the answer, rejected when the next one comes
close.
"""

from __future__ import annotations

import math
import re
from collections.abc import Mapping

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jobtide.llm.common import seeded_number

UNKNOWN = "und"
#: A dictionary is the start of so many texts, so many characters of each, bytes at most in all.
TEXTS, CHARS, DICTIONARY_BYTES = 64, 2_000, 96 << 10
#: Languages with dictionaries at most: their memory is bounded; more are an error, not ignored.
MOST_LANGUAGES = 512
#: A text is compressed in blocks of so many bytes, so that the dictionary is always in reach.
BLOCK = 8 << 10
LEVEL = 3
SHORT, SHORT_LEVEL = 512, 19
#: Saved share of the runner-up's bytes below which an answer is rejected.
NARROW = 0.02
#: What foreign dictionaries save is measured with the longest dictionaries, on so many pieces of
#: other languages of each length, and at most with so many dictionaries cut to each size.
PROBES, PROBE_LENGTHS, DONORS = 24, (64, 256, 1_024, 4_096, BLOCK), 4
PROBE_SIZES = (0, 256, 1 << 10, 4 << 10, 16 << 10, 48 << 10, DICTIONARY_BYTES)
#: Log odds per saved byte.
SHARPNESS = 0.35
SALTS = 64
SEED = 6


_OTHERS = re.compile(r"[\W\d_]+")


def letters(text: str) -> bytes:
    """The text's words of letters in lower case: case, digits and symbols tell no language."""
    return _OTHERS.sub(" ", text.lower()).strip().encode()


def dictionaries(
    docs: DataFrame,
    usable: Column,
    lang_col: str = "lang",
    id_col: str = "doc_id",
    text_col: str = "text",
    texts: int = TEXTS,
    chars: int = CHARS,
) -> dict[str, bytes]:
    """Raw dictionary content of each language, from a bounded seeded sample of ``usable`` rows,
    the language with most rows first.

    Ids are chosen from ids and languages alone, ``texts`` for each language: first within salts
    of a language, so that one that holds most rows is not one group, then among those winners.
    Only then are the chosen texts read. Rows with NULL language, id or text, and texts without
    letters, are no samples. More than ``MOST_LANGUAGES`` languages raise an error.
    """
    ids = docs.where(
        usable & docs[lang_col].isNotNull() & docs[id_col].isNotNull() & docs[text_col].isNotNull()
    ).select(docs[lang_col].alias("lang"), docs[id_col].alias("id"))
    ids = ids.withColumn("draw", seeded_number(F.col("id"), SEED))
    plain = ids
    salted = Window.partitionBy("lang", F.col("draw") % SALTS).orderBy("draw", "id")
    ids = ids.withColumn("nth", F.row_number().over(salted)).where(F.col("nth") <= texts)
    counts = {
        r["lang"]: r["count"] for r in plain.groupBy("lang").count().limit(MOST_LANGUAGES).collect()
    }
    whole = Window.partitionBy("lang").orderBy("draw", "id")
    ids = ids.withColumn("nth", F.row_number().over(whole)).where(F.col("nth") <= texts)
    chosen = {(r["lang"], r["id"]): r["nth"] for r in ids.limit(MOST_LANGUAGES * texts + 1).collect()}
    if len({lang for lang, _ in chosen}) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    keys = docs.sparkSession.createDataFrame(
        [(lang, i, n) for (lang, i), n in chosen.items()] or [(None, None, None)],
        f"lang string, id {docs.schema[id_col].dataType.simpleString()}, nth int",
    )
    found = (
        docs.select(
            docs[lang_col].alias("lang"),
            docs[id_col].alias("id"),
            F.substring(docs[text_col], 1, chars).alias("text"),
        )
        .join(F.broadcast(keys), ["lang", "id"])  # texts * languages rows
        .where(F.col("text").rlike(r"\p{L}"))
        .select("lang", "nth", "text")
        .collect()
    )
    content: dict[str, list[bytes]] = {}
    for row in sorted(found, key=lambda r: (r["lang"], r["nth"], r["text"])):
        content.setdefault(row["lang"], []).append(letters(row["text"]))
    by_rows = sorted(content, key=lambda lang: (-counts.get(lang, 0), lang))
    return {lang: b" ".join(content[lang])[:DICTIONARY_BYTES] for lang in by_rows}


def _compressor(raw: bytes, level: int) -> zstandard.ZstdCompressor:
    found = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    found.precompute_compress(level=level)
    return zstandard.ZstdCompressor(dict_data=found, write_checksum=False, write_content_size=False)


def allowances(content: Mapping[str, bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Bytes a block's size is reduced by for each language, as its dictionary is shorter than the
    longest: (sizes of blocks with the worst dictionary, (size, language) bytes).

    A longer dictionary matches more of anything, in any language. How much more is measured: the
    longest dictionaries are cut to several sizes and compress pieces of other languages. Languages
    with equally long dictionaries get equal allowances, the longest one none.
    """
    lengths = np.array([len(c) for c in content.values()])
    none = np.zeros(1), np.zeros((1, len(content)))
    if len(content) < 2 or lengths.min() == lengths.max():
        return none
    longest = int(lengths.max())
    donors = sorted(content, key=lambda lang: (-len(content[lang]), lang))[:DONORS]
    donors = [d for d in donors if 2 * len(content[d]) >= longest]
    cuts = sorted({s for s in PROBE_SIZES if s < longest} | {longest})
    made = {}
    at, rows = [0.0], [np.zeros(len(content))]
    for length in PROBE_LENGTHS:
        level = SHORT_LEVEL if length <= SHORT else LEVEL
        sizes = []
        for donor in donors:
            others = [c for lang, c in content.items() if lang != donor and len(c) >= length]
            pieces = [
                c[i : i + length]
                for n, c in enumerate(others[:PROBES])
                for k in range(-(-PROBES // len(others[:PROBES])))
                for i in [(len(c) - length) * (2 * k + n % 2) // (2 * PROBES)]
            ]
            if not pieces:
                continue
            for cut in cuts:
                if (donor, cut, level) not in made:
                    made[donor, cut, level] = (
                        _compressor(content[donor][:cut], level)
                        if cut
                        else zstandard.ZstdCompressor(
                            level=level, write_checksum=False, write_content_size=False
                        )
                    )
            sizes.append(
                [np.mean([len(made[donor, cut, level].compress(p)) for p in pieces]) for cut in cuts]
            )
        if sizes:
            mean = np.minimum.accumulate(np.mean(sizes, axis=0))
            at.append(max(float(mean[0]), at[-1] + 1))
            rows.append(np.interp(lengths, cuts, mean) - mean[-1])
    return np.array(at), np.array(rows)


class Identifier:
    """Compressors of all languages at two levels: short texts are worth a closer search."""

    def __init__(
        self, content: Mapping[str, bytes], allowed: tuple[np.ndarray, np.ndarray] | None = None
    ):
        self.languages = list(content)
        self.at, self.allowed = allowances(content) if allowed is None else allowed
        self.levels = {}
        for level in (LEVEL, SHORT_LEVEL):
            self.levels[level] = [_compressor(content[lang], level) for lang in self.languages]

    def sizes(self, data: bytes) -> list[float]:
        """Bytes of the text with each dictionary, less what a longer one would save anyway."""
        compressors = self.levels[SHORT_LEVEL if len(data) <= SHORT else LEVEL]
        view = memoryview(data)
        blocks = [view[i : i + BLOCK] for i in range(0, len(data), BLOCK)]
        each = [[len(c.compress(block)) for block in blocks] for c in compressors]
        found = [float(sum(sizes)) for sizes in each]
        if len(self.at) > 1:
            total = np.zeros(len(found))
            for worst in map(max, zip(*each)):
                k = min(int(np.searchsorted(self.at, worst)), len(self.at) - 1)
                part = min((worst - self.at[k - 1]) / (self.at[k] - self.at[k - 1]), 1.0)
                total += self.allowed[k - 1] + part * (self.allowed[k] - self.allowed[k - 1])
            # Whole bytes, as sizes are: parts of a byte would decide between equals.
            found = [s - x for s, x in zip(found, np.floor(total).tolist())]
        return found

    def identify(self, text: str | None) -> tuple[str, float, bool]:
        """(language, score, rejected)."""
        if text is None or not self.languages or not any(map(str.isalpha, text)):
            return UNKNOWN, 0.0, True
        sizes = self.sizes(letters(text))
        best = min(range(len(sizes)), key=sizes.__getitem__)
        least = sizes[best]
        score = 1 / sum(math.exp(max(-700.0, -SHARPNESS * (s - least))) for s in sizes)
        rest = sizes[:best] + sizes[best + 1 :]
        margin = (min(rest) - least) / max(1.0, min(rest)) if rest else 1.0
        return self.languages[best], score, margin < NARROW


def identify(docs: DataFrame, content: Mapping[str, bytes], text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` (0 to 1) and ``rejected``.

    The language with the smallest result wins, of equals the one learned from more rows; ``score`` is its
    share under odds of e to the bytes saved. Every language keeps its own dictionary; sizes are
    reduced by what longer dictionaries save on foreign texts (``allowances``). ``rejected`` marks margins under two percent. NULL
    texts and texts without letters are ``und`` with score 0, as is everything when no language
    was learned. Whole texts are compressed, in blocks. Columns with the new names are replaced.
    """
    content = dict(content)
    allowed = allowances(content)
    kind = "struct<lang_pred: string, score: double, rejected: boolean>"

    @F.arrow_udf(kind)
    def guess(batches: pa.Array) -> pa.Array:
        known = _identifier(content, allowed)
        found = [known.identify(text.as_py()) for text in batches]
        return pa.StructArray.from_arrays(
            [
                pa.array([f[0] for f in found], pa.string()),
                pa.array([f[1] for f in found], pa.float64()),
                pa.array([f[2] for f in found], pa.bool_()),
            ],
            names=["lang_pred", "score", "rejected"],
        )

    new = ("lang_pred", "score", "rejected")
    kept = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in new]
    row = docs.select(*kept, guess(docs[text_col]).alias("__guess"))
    return row.select("*", "__guess.*").drop("__guess")


_LAST: list = []


def _identifier(content: Mapping[str, bytes], allowed: tuple) -> Identifier:
    """The Python worker's identifier for this content, built once."""
    if not _LAST or _LAST[0] != content:
        _LAST[:] = [content, Identifier(content, allowed)]
    return _LAST[1]
