"""Licence scans: TF-IDF cosine of files, blocks and lines to templates, then inheritance from the nearest ancestor directory."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from importlib import resources

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidewave.llm.common import batches_of, stored

#: Short notices by which licences are told, in the words of their own recommended notices.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "The MIT License. Permission is hereby granted, free of charge, to any person obtaining a copy of this software."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0. Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0. Creative Commons Attribution ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0 license."),
]
#: SPDX lines, of the same licences and some more.
_NAMES = sorted({n for n, _ in TEMPLATES} | {"BSD-2-Clause", "LGPL-2.1", "ISC", "Unlicense", "0BSD", "Zlib", "EPL-2.0", "BSL-1.0"})
TEMPLATES += [(n, f"SPDX-License-Identifier: {n}") for n in _NAMES]
TEMPLATES += [(n, f"SPDX-License-Identifier: {n}-{end}") for n in _NAMES if "GPL" in n for end in ("only", "or-later")]
#: Least cosine with a template; share of a file's words in notices that makes it a licence file.
LEAST, WHOLE = 0.6, 0.3

_TERM = re.compile(r"[a-z0-9]+(?:[.\-][a-z0-9]+)*")


def license_texts() -> list[tuple[str, str]]:
    """The licence texts beside this module; a file's name is its licence."""
    folder = resources.files("tidewave.llm").joinpath("licenses")
    return [(f.name.removesuffix(".txt"), f.read_text(encoding="utf-8")) for f in sorted(folder.iterdir(), key=lambda f: f.name)]


def _plain_terms(text: str) -> list[str]:
    """Lower-cased words of letters, digits, dots and hyphens between them."""
    return _TERM.findall(text.lower())


class Templates:
    """TF-IDF vectors of notices and licence texts, and the scores of files with them."""

    def __init__(self, notices: list[tuple[str, str]], texts: list[tuple[str, str]], seen: dict[str, int], total: int, least: float):
        self.names, self.least, self.notices = [n for n, _ in notices + texts], least, len(notices)
        counts = [Counter(_plain_terms(t)) for _, t in notices + texts]
        self.sizes = [sum(c.values()) for c in counts]
        self.longest = max(self.sizes[: self.notices], default=1)
        self.place = {t: i for i, t in enumerate(sorted(set().union(*counts)))}
        self.other = math.log(1 + total + len(counts))  # words that no template holds weigh as rare ones
        self.weight = np.array([math.log((1 + total + len(counts)) / (1 + seen.get(t, 0) + sum(t in c for c in counts))) + 1e-3 for t in self.place])
        self.unit = np.zeros((len(self.place), len(counts)))
        for k, c in enumerate(counts):
            for t, n in c.items():
                self.unit[self.place[t], k] = n * self.weight[self.place[t]]
        self.unit /= np.linalg.norm(self.unit, axis=0)
        # A block without any of a template's heavy terms stays below ``least``: the others are too short a part of its vector.
        self.heavy = set()
        terms = list(self.place)
        for k in range(self.notices):
            part = self.unit[:, k] ** 2
            order = np.argsort(part, kind="stable")
            self.heavy |= {terms[i] for i in order[np.cumsum(part[order]) >= least**2 - 1e-9]}

    def cosines(self, count: Counter) -> np.ndarray:
        """With every template, of a block with these counts of terms."""
        known = [(self.place[t], n) for t, n in count.items() if t in self.place]
        if not known:
            return np.zeros(len(self.names))
        at = np.array([i for i, _ in known])
        own = np.array([n for _, n in known]) * self.weight[at]
        rest = sum(n * n for t, n in count.items() if t not in self.place) * self.other**2
        return own @ self.unit[at] / math.sqrt(own @ own + rest)

    def best(self, score: np.ndarray, first: int, last: int) -> tuple[float, str]:
        return max((round(float(score[k]), 9), self.names[k]) for k in range(first, last))

    def file(self, text: str | None) -> tuple[float | None, str | None, bool]:
        """Score and licence of the best block that reaches ``least``, and whether WHOLE of the words are in such blocks."""
        terms = _plain_terms(text or "")
        count = Counter(terms)
        found: list[tuple[float, str, int]] = []  # with the words of the block
        at = np.array([self.place[t] for t in count if t in self.place], dtype=np.int64)
        # dot <= |block| * |the template's part in shared terms|: a text of which the file has less can't reach ``least``.
        reach = (self.unit[at, self.notices :] ** 2).sum(axis=0)
        texts = np.flatnonzero(reach >= self.least**2 - 1e-9) + self.notices
        if len(texts):
            score = self.cosines(count)
            found.append((*max((round(float(score[k]), 9), self.names[k]) for k in texts), len(terms)))
            for k in texts:
                size, last = self.sizes[k], len(terms) - self.sizes[k]
                for begin in sorted({*range(0, last, max(1, size // 4)), last}) if last > 0 else []:
                    found.append((round(float(self.cosines(Counter(terms[begin : begin + size]))[k]), 9), self.names[k], size))
        found = sorted((f for f in found if f[0] >= self.least), reverse=True)[:1]
        if not self.heavy.isdisjoint(count):
            found += self.notice_blocks(text)
        if not found:
            return None, None, False
        words = max(found[0][2], sum(f[2] for f in found[1:]))
        score, name = max(f[:2] for f in found)
        return score, name, words >= WHOLE * len(terms)

    def notice_blocks(self, text: str) -> list[tuple[float, str, int]]:
        """(score, licence, words) of the best lines, or runs of lines with words, without overlap, that reach ``least``.

        A notice wrapped anyhow has as many lines as it has words at most; runs of more lines, or of three times
        the longest notice's words, which are too many others for LEAST, are not tried. Single lines are, however long.
        """
        lines = [_plain_terms(line) for line in text.split("\n")]
        held = [not self.heavy.isdisjoint(line) for line in lines]
        tried: dict[tuple[int, int], tuple[float, str]] = {}
        for i in (i for i, h in enumerate(held) if h):
            for a in range(i, max(-1, i - self.longest), -1):
                if not lines[a]:
                    break
                count: Counter = Counter()
                for b in range(a, min(len(lines), a + self.longest)):
                    if not lines[b] or (b > a and count.total() + len(lines[b]) > 3 * self.longest):
                        break
                    count.update(lines[b])
                    if b >= i and (a, b) not in tried:
                        tried[a, b] = self.best(self.cosines(count), 0, self.notices)
        out, used = [], set()
        for (a, b), (score, name) in sorted(tried.items(), key=lambda r: (-r[1][0], r[0])):
            if score >= self.least and used.isdisjoint(range(a, b + 1)):
                used |= set(range(a, b + 1))
                out.append((score, name, sum(map(len, lines[a : b + 1]))))
        return out


def directories(path: Column) -> Column:
    """The directories that hold ``path``, nearest first; the root is ''."""
    parts = F.split(path, "/")
    return F.transform(
        F.sequence(F.lit(1), F.size(parts)),
        lambda k: F.array_join(F.slice(parts, F.lit(1), F.greatest(F.size(parts) - k, F.lit(0))), "/"),
    )


def license_scan(files: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, least: float = LEAST, texts: list[tuple[str, str]] | None = None) -> DataFrame:
    """The licence of every file (file_id, path, text), by its own notices or its directories' licence files.

    Cosines of TF-IDF vectors, with document frequencies over all files and templates, compare the short notices of
    ``templates`` with every line and every run of lines, and ``texts`` (license_texts()) with the whole file and with
    windows of each text's length, a quarter of it apart. Files and lines are passed over only where the terms they
    share with a template prove that they can't reach ``least``. The best block names the file's own licence (``origin``
    notice). A file with WHOLE of its words in blocks that match is a licence file: it speaks for its directory (the best
    cosine, then the greatest name, if there are several). A file without a notice inherits from the nearest directory
    above it that has one, however far (``origin`` inherited); others have none (``origin`` none).

    Columns: file_id, license, score, origin, from_path. Null texts have no lines; a null path has no directories;
    repeated rows each give a row; other columns are ignored; an empty table gives an empty result.
    """
    spark = files.sparkSession
    texts = license_texts() if texts is None else texts
    vocabulary = frozenset(t for _, text in templates + texts for t in _plain_terms(text))
    known = spark.sparkContext.broadcast(vocabulary)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, names = Counter(), known.value
        for b in batches_of(batches, 256):
            for text in b.column("text").to_pylist():
                seen.update(names & set(_plain_terms(text or "")))
                seen[""] += 1  # files
        yield pa.record_batch([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], ["term", "n"])

    seen = {r["term"]: r["n"] for r in files.select("text").mapInArrow(count, "term string, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()}
    held = spark.sparkContext.broadcast(Templates(templates, texts, seen, seen.get("", 0), least))
    base = files.select("file_id", "path", "text").withColumn("row", F.monotonically_increasing_id())

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = held.value
        for b in batches_of(batches, 256):
            score, name, whole = zip(*[own.file(t) for t in b.column("text").to_pylist()]) if b.num_rows else ((), (), ())
            columns = [b.column("row"), b.column("file_id"), b.column("path"), pa.array(score, pa.float64()), pa.array(name, pa.string()), pa.array(whole, pa.bool_())]
            yield pa.record_batch(columns, ["row", "file_id", "path", "score", "license", "whole"])

    shape = StructType([base.schema[c] for c in ("row", "file_id", "path")]).add("score", "double").add("license", "string").add("whole", "boolean")
    held_rows = stored(base.mapInArrow(scan, shape), "licenses").withColumn("best", F.when(F.col("score").isNotNull(), F.struct("score", "license")))
    folders = (
        held_rows.where(F.col("whole") & F.col("path").isNotNull())
        .select(directories(F.col("path"))[0].alias("dir"), "best", "path")
        .groupBy("dir").agg(F.max(F.struct("best.score", "best.license", "path")).alias("given"))
    )
    # Many files ask for the same directories: these are joined once each, files by their own directory.
    near = held_rows.where(F.col("best").isNull() & F.col("path").isNotNull()).select("row", directories(F.col("path"))[0].alias("own"), "path")
    wanted = near.groupBy("own").agg(F.min("path").alias("path")).select("own", F.posexplode(directories(F.col("path"))).alias("far", "dir"))
    answers = (
        wanted.join(folders, "dir").groupBy("own").agg(F.min(F.struct("far", "given")).alias("answer"))
        .select("own", "answer.given")
    )
    inherited = near.join(answers, "own").select("row", "given")
    return held_rows.select("row", "file_id", "path", "best").join(inherited, "row", "left").select(
        "file_id",
        F.coalesce("best.license", "given.license").alias("license"),
        F.coalesce("best.score", "given.score").alias("score"),
        F.when(F.col("best").isNotNull(), "notice").when(F.col("given").isNotNull(), "inherited").otherwise("none").alias("origin"),
        F.when(F.col("best").isNotNull(), F.col("path")).otherwise(F.col("given.path")).alias("from_path"),
    )
