"""Language identification by compression against per-language dictionaries.

For each language some labelled texts become a raw-content zstandard dictionary. A text is compressed
once with each of them; the language whose dictionary makes it smallest is its language. Where the
margin to the second is narrow, the prediction is rejected. By chance, margins grow as the root of the size, so
they are measured in roots of the size, and the least one is fitted: other labelled texts are cut into
pieces of a few words, all but a stated share of which must pass.

Zstandard counts in bytes, which is coarse for a few words. To the size of a short text is added the
number of phrases of the dictionary that the text falls into, each as long as possible; they count less
and less up to ``SHORT`` bytes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkspur.llm.common import release, slices

#: Bounds of the training sample: texts a language, characters that are used of each, bytes of a
#: dictionary, and languages. They bound what the driver holds: languages times dictionary bytes.
SAMPLE_TEXTS = 64
LONGEST_SAMPLE = 10_000
DICTIONARY_BYTES = 64 * 1024
MAX_LANGUAGES = 256
#: The margin is fitted on so many pieces of so many words, in all; this share of them may be rejected.
FITTED_PIECES = 512
PIECE_WORDS = 5
REJECTED_SHARE = 0.02
LEVEL = 6
#: Bytes of margin by which the odds between two languages grow by the factor e.
SCALE = 2.0
#: Bytes of letters from which phrases count no more, and up to which they count in full.
SHORT = 200
SHORTEST = 100
UNKNOWN = "und"

SCHEMA = "doc_id long, lang_pred string, score double, margin double, accepted boolean"


def plain(texts: pa.Array) -> pa.Array:
    """Lower-case letters with one space between runs of them, and at either end."""
    lower = pc.utf8_lower(pc.fill_null(texts, ""))
    return pc.replace_substring_regex(lower, pattern=r"(^|[^\pL\pM]+|$)([^\pL\pM]+|$)?", replacement=" ")


class Dictionaries(dict[str, bytes]):
    """Raw-content dictionaries by label, and the margin from which a prediction is accepted."""

    minimum = 0.0

    def fixed(self) -> tuple[tuple[str, bytes], ...]:
        return tuple(sorted(self.items()))


def learn_dictionaries(
    docs: DataFrame,
    *,
    text: str = "text",
    label: str = "lang",
    sample_texts: int = SAMPLE_TEXTS,
    longest: int = LONGEST_SAMPLE,
    dictionary_bytes: int = DICTIONARY_BYTES,
    max_languages: int = MAX_LANGUAGES,
) -> Dictionaries:
    """Raw-content dictionaries by label, of about ``sample_texts`` distinct texts each, and the least margin.

    The texts are chosen by a hash of their content, at a rate that follows from the number of distinct
    texts with that label, so the sample is the same however the rows are dealt out and copies count
    once. Of each, the first ``longest`` characters are used. As many further texts fit the margin; where a
    table has none, it is 0. Rows without text or label are not chosen.
    Raises ValueError for more than ``max_languages`` labels.
    """
    usable = docs.select(F.col(text).cast("string").alias("text"), F.col(label).cast("string").alias("lang")).where(
        F.col("lang").isNotNull() & (F.length("text") > 0)
    )
    hashed = usable.withColumn("key", F.xxhash64("text"))
    counts = {
        r["lang"]: r["texts"]
        for r in hashed.groupBy("lang").agg(F.approx_count_distinct("key").alias("texts")).limit(max_languages + 1).collect()
    }
    if len(counts) > max_languages:
        raise ValueError(f"more than {max_languages} languages")
    if not counts:
        return Dictionaries()
    span = 1 << 31
    rate = F.create_map(*[F.lit(v) for k, n in counts.items() for v in (k, min(span, int(span * sample_texts / max(1, n)) + 1))])
    place = F.pmod("key", F.lit(span)) / F.element_at(rate, F.col("lang"))
    chosen = (
        hashed.withColumn("use", F.floor(place))
        .where("use < 2")
        .select("lang", "key", "use", F.substring("text", 1, longest).alias("text"))
        .dropDuplicates(["lang", "key"])
        .collect()
    )
    grouped: dict[str, list[tuple[int, str]]] = {}
    for row in chosen:
        if row["use"] == 0:
            grouped.setdefault(row["lang"], []).append((row["key"], row["text"]))
    learned = Dictionaries()
    for lang, texts in sorted(grouped.items()):
        joined = "".join(plain(pa.array([t for _, t in sorted(texts)])).to_pylist()).encode()
        if joined.strip():
            learned[lang] = joined[:dictionary_bytes]
    learned.minimum = _least_margin(learned, sorted((r["key"], r["lang"], r["text"]) for r in chosen if r["use"] == 1))
    return learned


def _least_margin(learned: Dictionaries, texts: list[tuple[int, str, str]]) -> float:
    """The margin that all but ``REJECTED_SHARE`` of the pieces of labelled texts reach."""
    pieces = []
    for _, lang, text in texts:
        words = plain(pa.array([text]))[0].as_py().split()
        each = max(1, FITTED_PIECES // len(texts))
        starts = [int(i * max(0, len(words) - PIECE_WORDS) / each) for i in range(each)]
        pieces += [(lang, " ".join(words[i : i + PIECE_WORDS])) for i in dict.fromkeys(starts) if len(words) >= PIECE_WORDS]
    if not pieces or len(learned) < 2:
        return 0.0
    found = classify(pa.array([p for _, p in pieces]), learned.fixed(), LEVEL, SCALE)
    # Pieces of junk or of another language than their text's label say nothing of margins.
    margins = [margin for (lang, _), (name, _, margin) in zip(pieces, found, strict=True) if lang == name]
    return float(np.quantile(margins, REJECTED_SHARE)) if margins else 0.0


@lru_cache(maxsize=4)
def _compressors(dictionaries: tuple[tuple[str, bytes], ...], level: int) -> list[zstandard.ZstdCompressor]:
    made = []
    for _, content in dictionaries:
        dictionary = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        dictionary.precompute_compress(level=level)
        made.append(zstandard.ZstdCompressor(level=level, dict_data=dictionary, write_content_size=False, write_checksum=False, write_dict_id=False))
    return made


def phrases(content: bytes, dictionary: bytes) -> int:
    """Pieces of ``dictionary``, each as long as possible, that ``content`` is put together from."""
    count = at = 0
    while at < len(content):
        size = 1
        while at + size < len(content) and content[at : at + size + 1] in dictionary:
            size += 1
        at += size
        count += 1
    return count


def classify(texts: pa.Array, dictionaries: tuple[tuple[str, bytes], ...], level: int, scale: float) -> Iterator[tuple[str, float, float]]:
    """Language, score in 0 to 1 and margin (in roots of the size) for each text."""
    compressors = _compressors(dictionaries, level)
    names = [name for name, _ in dictionaries]
    for value in plain(texts):
        content = value.as_py().encode()
        if not compressors or not content.strip():
            yield UNKNOWN, 0.0, 0.0
            continue
        sizes = np.array([len(c.compress(content)) for c in compressors], float)
        if len(content) < SHORT:
            share = min(1.0, (SHORT - len(content)) / (SHORT - SHORTEST))
            sizes += [share * phrases(content, dictionary) for _, dictionary in dictionaries]
        order = np.argsort(sizes, kind="stable")
        best = int(order[0])
        margin = float((sizes[order[1]] if len(sizes) > 1 else len(content)) - sizes[best])
        yield names[best], float(1 / np.exp((sizes[best] - sizes) / scale).sum()), max(0.0, margin) / float(np.sqrt(sizes[best]))


def wide(lang: str, margin: float, minimum: float) -> bool:
    """Whether a prediction is accepted; ties never are."""
    return lang != UNKNOWN and margin > 0 and margin >= minimum


def _identified(dictionaries: tuple[tuple[str, bytes], ...], level: int, scale: float, minimum: float) -> Callable:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            found = list(classify(batch.column(1), dictionaries, level, scale))
            langs, scores, margins = zip(*found, strict=True)
            accepted = [wide(lang, margin, minimum) for lang, _, margin in found]
            columns = [batch.column(0), pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(margins, pa.float64()), pa.array(accepted)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "lang_pred", "score", "margin", "accepted"])
        release()

    return run


def identify(
    docs: DataFrame,
    dictionaries: dict[str, bytes],
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    level: int = LEVEL,
    scale: float = SCALE,
    minimum: float | None = None,
) -> DataFrame:
    """One row per row of ``docs``: language, score, margin and whether the margin is wide enough.

    The least margin is the one learned with the dictionaries unless ``minimum`` is given; ``margin`` is in
    roots of the compressed size. The whole text is compressed. Ties go to the first language by name, with a low score. A text that
    is NULL or has no letter, and every text where nothing was learned, is ``und`` with score 0, and
    rejected. Repeated rows are judged alike; other columns are not read; no rows give no rows.
    """
    chosen = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    least = getattr(dictionaries, "minimum", 0.0) if minimum is None else minimum
    return chosen.mapInArrow(_identified(tuple(sorted(dictionaries.items())), level, scale, least), SCHEMA)


def keep_accepted(
    docs: DataFrame,
    dictionaries: dict[str, bytes],
    *,
    text: str = "text",
    level: int = LEVEL,
    minimum: float | None = None,
) -> DataFrame:
    """The rows of ``docs`` whose language is accepted, with all their columns."""
    at = docs.columns.index(text)
    learned = tuple(sorted(dictionaries.items()))
    least = getattr(dictionaries, "minimum", 0.0) if minimum is None else minimum

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            found = classify(batch.column(at), learned, level, SCALE)
            yield batch.filter(pa.array([wide(lang, margin, least) for lang, _, margin in found], pa.bool_()))
        release()

    return docs.mapInArrow(run, docs.schema)


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows kept from learning: a quarter, by the CRC of the id as text. A NULL id is not held out."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))
