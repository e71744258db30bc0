"""Quality of pages and files, and the budget of the OCR fallback."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as X

OCR_PAGES, SAMPLE_PAGES = 60, 20


def page_quality(pages: DataFrame, text: str = "text") -> DataFrame:
    return pages.withColumn("verdict", X.quality(F.col(text)))


def file_quality(pages: DataFrame, file: str, page: str, key: str, text: str = "text", first: int = SAMPLE_PAGES) -> DataFrame:
    """Verdict on the text of a file's first pages taken together, with its ratios.

    The pages of a file are cut to the sample before they are brought together, so a file's size does not matter.
    """
    order = Window.partitionBy(file).orderBy(page, key)
    sample = pages.select(file, page, key, text).withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= first)
    whole = sample.groupBy(file).agg(
        F.count("*").alias("pages_sampled"),
        X.strip(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_rank", F.coalesce(text, F.lit("")).alias("t")))), lambda s: s["t"]), "")).alias("_t"),
    )
    t, chars = F.col("_t"), F.length("_t")
    poor = chars / F.col("pages_sampled") < X.MIN_CHARS
    garbled = (X.printable_ratio(t) < X.MIN_PRINTABLE) | (X.weird_ratio(t) > X.MAX_WEIRD) | (X.alnum_ratio(t) < X.MIN_ALNUM)
    return whole.select(
        file, "pages_sampled", chars.alias("total_chars"), F.round(chars / F.col("pages_sampled"), 4).alias("avg_chars_per_page"),
        F.when(~poor, F.bround(X.alnum_ratio(t), 3)).alias("alnum_ratio"), F.when(~poor, F.bround(X.printable_ratio(t), 3)).alias("printable_ratio"),
        F.when(poor, "EMPTY/SCANNED").when(garbled, "GARBLED").otherwise("CLEAN").alias("verdict"),
    )


def verdict_counts(files: DataFrame) -> DataFrame:
    """Files of each verdict and their share of all."""
    counts = files.groupBy("verdict").agg(F.count("*").alias("files"))
    return counts.select("verdict", "files", F.round(F.col("files") / F.sum("files").over(Window.partitionBy()), 6).alias("share"))  # a row a verdict


def ocr_budget(pages: DataFrame, file: str, page: str, key: str, text: str = "text", most: int = OCR_PAGES) -> DataFrame:
    """Pages that are not clean, in page order, with whether the file's OCR budget still covers them."""
    bad = page_quality(pages, text).where(F.col("verdict") != "CLEAN")
    rank = F.row_number().over(Window.partitionBy(file).orderBy(page, key))
    return bad.withColumn("ocr_rank", rank).withColumn("covered", F.col("ocr_rank") <= most)


def better_text(native: Column, ocr: Column) -> Column:
    """The OCR text only where it is strictly longer once stripped."""
    return F.when(F.length(X.strip(F.coalesce(ocr, F.lit("")))) > F.length(X.strip(F.coalesce(native, F.lit("")))), ocr).otherwise(native)


def ocr_fallback(pages: DataFrame, read: Callable[[str, int], str], file: str = "source_rel", page: str = "page_num", text: str = "text", most: int = OCR_PAGES) -> DataFrame:
    """Pages whose text is not clean, read again by `read(file, page)` until a file has had `most` successful readings.

    The reading is taken where it is longer; such a page has method ocr and neither spans nor tables. Pages beyond the
    budget, and those whose reading fails, keep their text and say so in `note`; failed readings are not charged. A page
    that was delivered twice is read once. Only the numbers of pages that are to be read reach the reader, each file's in
    order, one after the other.
    """
    judged = page_quality(pages, text).withColumn("_bad", F.col("verdict") != "CLEAN").drop("verdict")
    asked = judged.where("_bad").select(F.col(file).alias("file"), F.col(page).cast("int").alias("page")).distinct()

    def again(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, used = object(), 0
        for batch in batches:
            out = []
            for f, n in zip(batch["file"], batch["page"]):
                if f != current:
                    current, used = f, 0
                if used >= most:
                    out.append((f, n, None, "ocr budget used up"))
                    continue
                try:
                    out.append((f, n, read(f, int(n)), None))
                    used += 1
                except Exception as e:  # noqa: BLE001  a page that cannot be read keeps its text
                    out.append((f, n, None, f"ocr failed: {type(e).__name__}: {e}"))
            yield pd.DataFrame(out, columns=["file", "page", "new", "note"])

    known = asked.where("page IS NOT NULL").repartition("file").sortWithinPartitions("file", "page").mapInPandas(again, "file string, page int, new string, note string")
    met = judged["_bad"] & judged[file].eqNullSafe(known["file"]) & judged[page].eqNullSafe(known["page"])
    longer = F.length(X.strip(F.coalesce("new", F.lit("")))) > F.length(X.strip(F.coalesce(F.col(text), F.lit(""))))
    kinds = pages.schema
    new = {c: F.when(longer, F.array().cast(kinds[c].dataType)).otherwise(F.col(c)) for c in ("spans", "tables") if c in pages.columns}
    new |= {text: F.when(longer, F.col("new")).otherwise(F.col(text))} | ({"method": F.when(longer, "ocr").otherwise(F.col("method"))} if "method" in pages.columns else {})
    return judged.join(known, met, "left").select(*[new.get(c, judged[c]).alias(c) for c in pages.columns], "note")
