"""Keyword-stuffed and link-list pages.

Every whole text is measured by content and link features. Rules that are sure about a part
of the pages give weak labels; bagged decision trees learn from a bounded sample of them what
the features say about all pages; and the page predictions are smoothed with the mean
prediction of the other pages of the host.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from rosterweave.llm.trees import bag, predict
from rosterweave.operators.joins import lookup_join
from rosterweave.storage import cut

# Frequent function words of the languages of the corpus.
FUNCTION_WORDS = frozenset(
    "the a an of to and in is that for we was with my at on as it be our you are this by or not from her his they them who what which how before after when than but had have has were said so no do did if all more one will would can could should may than its their your i me he she us about into over"
    " der die das und ist zu mit den dem des für im ein eine einen einer von auf als nach wir ich sie er es sich nicht bei aus wird werden war hat haben wer wie am um oder aber beim ab zum zur seit keine"
    " el la los las en que y un una por con del al lo se es no su sus para como más pero desde muy mi me hasta fue cada"
    " le les et du est pour dans je il elle nous vous au aux ce cette qui sur ne pas par sont avec d l qu chez son sa ses leur été mais depuis notre chaque".split()
)
FEATURES = ("prose", "prose_loose", "function", "unique", "top_word", "top_pair", "links", "tags", "long_words", "marks", "short_lines", "same_starts", "words", "repeat_lines", "segments_prose", "headings", "periods", "listed")
_WORD = re.compile(r"[^\W\d_]+")
_LINK = re.compile(r"(?:https?://|www\.)\S+")
_TAG = re.compile(r"(?<!\w)#\w[\w.+/&-]*")
_MARKUP = re.compile(r"<[^<>]{1,400}>")
_DELIMITER = re.compile(r"[,;|/·•»>]|\s[-–]\s")
_HEADING = re.compile(r"[^\W\d_a-zà-ÿ][^\W\d_a-zà-ÿ &]{3,40}:?")
_PERIOD = re.compile(r"\b(?:19|20)\d\d\s*(?:-|–|to|bis)\s*(?:[^\W\d_]+\.? )?(?:present|heute|(?:19|20)\d\d)\b", re.I)
_SEGMENT = re.compile(r"[^.!?\n]*(?:\.(?=\S)[^.!?\n]*)*[.!?\n]*")


def _measure(text: str) -> list[float]:
    n = max(1, len(text))
    links, tags = _LINK.findall(text), _TAG.findall(text)
    link_share, tag_share = sum(map(len, links)) / n, sum(map(len, tags)) / n
    plain = _MARKUP.sub(" ", _TAG.sub(" ", _LINK.sub(" ", text)))
    words = [w.lower() for w in _WORD.findall(plain)]
    total = max(1, len(words))
    functions = sum(w in FUNCTION_WORDS for w in words) / total
    prose = loose = 0
    parts = [s for s in _SEGMENT.findall(plain) if s.strip()]
    good = kept = listed = 0
    said = Counter(w for w in words if w not in FUNCTION_WORDS)
    worn = {w for w, c in said.items() if c >= max(6, 0.045 * total)}  # words the text lives on
    for s in parts:
        ws = _WORD.findall(s.lower())
        size = len(s)
        if len(_DELIMITER.findall(s.strip(" -–•"))) > max(1, 0.22 * len(ws)):
            listed += size
            kept += 1
            continue
        ended = s.rstrip().endswith((".", "!", "?", "…", ":"))
        for i in range(0, max(1, len(ws)), 16):
            window = ws[i : i + 16]
            if len(ws) - i < 24 and i == 0:
                window = ws
            hits = sum(w in FUNCTION_WORDS for w in window)
            part = size * len(window) / max(1, len(ws))
            rate = hits / max(1, len(window))
            varied = len(set(window)) >= 0.6 * len(window)
            kept += 1
            content = [w for w in window if w not in FUNCTION_WORDS]
            fresh = 2 * sum(w in worn for w in content) < max(1, len(content))
            if len(window) >= 4 and hits >= 1 and rate >= 0.12 and varied and fresh and (ended or (len(window) >= 9 and hits >= 2)):
                prose += part
                good += 1
            if hits >= 1 and rate >= 0.07:
                loose += part
            if window is ws:
                break
    count = Counter(words)
    pairs = Counter(zip(words, words[1:], strict=False))
    top = sum(c for _, c in said.most_common(5)) / total
    lines = [x.strip() for x in text.splitlines() if x.strip()]
    starts = Counter(x[:6].lower() for x in lines)
    return [
        prose / n, loose / n, functions, len(count) / total, top, sum(c for _, c in pairs.most_common(3)) / total, link_share, tag_share,
        sum(len(w) for w in words if len(w) > 18) / n, sum(text.count(c) for c in ",;|/·•>»#") / total,
        sum(len(_WORD.findall(x)) < 7 for x in lines) / max(1, len(lines)), max(starts.values(), default=0) / max(1, len(lines)) if len(lines) > 3 else 0.0,
        math.log1p(len(words)), 1 - len(set(lines)) / max(1, len(lines)), good / max(1, kept),
        math.log1p(sum(bool(_HEADING.fullmatch(x)) for x in lines)), math.log1p(len(_PERIOD.findall(text))), listed / n,
    ]


def _features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        yield pd.DataFrame({"doc_id": batch["doc_id"], "site": batch["site"], "x": [_measure(t or "") for t in batch["text"]]})


def weak_label(x: np.ndarray) -> np.ndarray:
    """1 for pages that are surely repetition or listing, 0 for surely none, NaN where the
    rules leave the decision to the trees. Columns as in ``FEATURES``."""
    f = {name: x[:, i] for i, name in enumerate(FEATURES)}
    listing = (f["links"] > 0.5) | (f["tags"] > 0.5) | (f["top_pair"] > 0.12) | (f["marks"] > 0.3) | (f["long_words"] > 0.4) | (f["same_starts"] > 0.5) | (f["top_word"] > 0.4)
    long = f["words"] + f["links"] * 4 + f["tags"] * 4 > math.log1p(12)
    out = np.full(len(x), np.nan)
    record = (f["headings"] > math.log1p(1.5)) & (f["periods"] > 0)  # the form of a resume
    out[(f["prose"] < 0.25) & listing & long & ~record] = 1.0
    out[((f["prose"] < 0.4) & (f["top_pair"] > 0.2) & (f["unique"] < 0.15) & long)] = 1.0
    out[(f["prose"] > 0.6) | record & (f["prose"] > 0.25)] = 0.0
    return out


def find_spam(docs: DataFrame, train_rows: int = 20_000, smoothing: float = 0.15, prior_pages: float = 20.0) -> DataFrame:
    """``(doc_id, spam)``: the probability that each page is mainly repetition or listing.

    ``docs`` is ``(doc_id, text, site)``. Null and empty texts have no listing and get 0; a
    null site is a host of its own without smoothing. The trees learn from at most
    ``train_rows`` weakly labelled pages, taken by a hash of doc_id; everything else is over
    all pages and their whole texts. Repeated ids give a row each; without any weak label of
    both kinds the weak rule itself decides at half prose.
    """
    measured = cut(docs.select("doc_id", "site", "text").mapInPandas(_features, f"doc_id {dict(docs.dtypes)['doc_id']}, site string, x array<double>"), "features")
    head = {}
    for kind in (0.0, 1.0):
        labelled = measured.mapInPandas(_keep_label(kind), "doc_id string, x array<double>")
        head[kind] = labelled.orderBy(F.xxhash64("doc_id"), "doc_id").limit(train_rows // 2).collect()
    y = np.concatenate([np.full(len(head[k]), k) for k in (0.0, 1.0)])
    x = np.array([r.x for k in (0.0, 1.0) for r in head[k]], float).reshape(len(y), len(FEATURES))
    forest = bag(x, y) if head[0.0] and head[1.0] else []

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            v = np.array(batch["x"].tolist(), float).reshape(len(batch), len(FEATURES))
            p = predict(forest, v) if forest else (v[:, 0] < 0.5).astype(float)
            empty = (v[:, FEATURES.index("words")] == 0) & (v[:, 6] + v[:, 7] == 0)
            yield pd.DataFrame({"doc_id": batch["doc_id"], "site": batch["site"], "p": np.where(empty, 0.0, p)})

    pages = cut(measured.mapInPandas(score, f"doc_id {dict(docs.dtypes)['doc_id']}, site string, p double"), "pages")
    mean = pages.agg(F.coalesce(F.avg("p"), F.lit(0.0))).first()[0]
    hosts = cut(pages.where("site is not null").groupBy("site").agg(F.sum("p").alias("_sum"), F.count("*").alias("_n")), "hosts")
    joined = lookup_join(pages, hosts, ["site"], "left")
    clip = lambda c: F.greatest(F.least(c, F.lit(0.995)), F.lit(0.005))
    logit = lambda c: F.log(c / (1 - c))
    others = (F.col("_sum") - F.col("p") + prior_pages * mean) / (F.col("_n") - 1 + prior_pages)
    shift = F.when(F.col("_n").isNull(), F.lit(0.0)).otherwise(smoothing * (logit(clip(others)) - logit(clip(F.lit(mean)))))
    spam = 1 / (1 + F.exp(-(logit(clip(F.col("p"))) + shift)))
    return joined.select("doc_id", F.when(F.col("p") == 0, F.lit(0.0)).otherwise(F.round(spam, 6)).alias("spam"))


def _keep_label(kind: float):  # noqa: ANN202
    def keep(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            got = weak_label(np.array(batch["x"].tolist(), float).reshape(len(batch), len(FEATURES))) == kind
            yield pd.DataFrame({"doc_id": batch["doc_id"][got].astype(str), "x": batch["x"][got]})

    return keep
