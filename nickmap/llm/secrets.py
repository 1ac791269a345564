"""Secret scans: patterns propose findings, and a random forest trained on labelled findings removes the false ones.

The forest sees a candidate's length, its character transitions, how much of it common words cover, its path, and the
words beside it, and whether it has the form of a known token or of a host, path or date.
"""

from __future__ import annotations

import bisect
import hashlib
import math
import random
import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import held_out, table
from .quality import binned, quantile_cuts

#: At most so many labelled findings are trained on, those with the smallest hash of document and place.
MAX_FINDINGS = 20_000
#: At most so many passages of documents, of so many characters, have findings planted, PLANTS in each.
MAX_PASSAGES, PASSAGE, PLANTS = 1_000, 2_000, 12
#: Common words sent to the tasks: those found in the most documents.
DICTIONARY = 2_000
#: Characters of context on either side of a candidate.
CONTEXT = 48
#: Runs that can hold a candidate, each met once; what closes one; and prefixes by which it needs no digit.
_RUN = re.compile(r"[A-Za-z0-9+/_\-.@:]{12,}")
_PADDING = re.compile(r"={1,2}(?![A-Za-z0-9+/_\-.@:=\"'`])")
_DIGIT = re.compile(r"[0-9]")
_KNOWN = re.compile(r"(?:^|(?<=:))(?:gh[pousr]_|glpat-|[srp]k_(?:live|test)_|xox[abeoprs]-|npm_|hf_)")
_NAME = r"(?:token|secret|passw(?:or)?d|pwd|api[_-]?key|access[_-]?key|credential|auth)\w{0,64}"
_KEYWORD = re.compile(_NAME, re.I)
_ASSIGNED = re.compile(_NAME + r"[\"']?\s*[:=]+>?\s*[\"'`]?$", re.I)
#: Any value assigned to a credential's name: quoted, or up to white space or what parts fields.
_VALUE = re.compile(_NAME + r"[\"']?(?P<by>[ \t]*[:=]+>?[ \t]*)(?:\"(?P<a>[^\"\n]+)\"|'(?P<b>[^'\n]+)'|`(?P<c>[^`\n]+)`|(?P<d>[^\s\"'`&,;<>]+))", re.I)
#: A password within an address, and private keys over several lines.
_USER = re.compile(r"://[^\s/:@\"']*:(?P<a>[^\s/@\"']{3,})@")
_KEY_EDGE = re.compile(r"-----(?:(?P<begin>BEGIN)|END) [A-Z ]*PRIVATE KEY-----")
_KEY_BODY = re.compile(r"[A-Za-z0-9+/=\s:,\-]*")
_CONFIG = re.compile(r"(?:\.env|config|settings|deploy|secrets?|\.ya?ml|\.ini|\.toml|\.pem|\.properties)", re.I)
_SAMPLE = re.compile(r"(?:example|sample|test|dummy|mock|fixture)", re.I)
#: Forms of tokens that services give out.
_PREFIXED = re.compile(
    r"(?:gh[pousr]_\w{20,}|github_pat_\w{20,}|glpat-[\w\-]{16,}|[srp]k_(?:live|test)_\w{10,}|sk-[\w\-]{20,}|xox[abeoprs]-[\w\-]{10,}|(?:AKIA|ASIA)[0-9A-Z]{16}|AIza[\w\-]{30,}|ya29\.[\w\-]{20,}"
    r"|SG\.[\w\-]{16,}\.[\w\-]{16,}|npm_\w{30,}|pypi-[\w\-]{16,}|hf_\w{30,}|eyJ[\w\-]{8,}\.[\w\-]+\.[\w\-]*)=*"
)
_PART = r"(?:[A-Z]?[a-z]+\d{0,4}|[A-Z]+\d{0,4}|\d{1,4})"
_STEP = rf"(?:{_PART}(?:[_.\-]{_PART})*)"
#: Hosts and addresses, e-mail, URLs without a user, paths, dates and times, versions.
_ORDINARY = re.compile(
    rf"(?:(?:\d{{1,3}}\.){{3}}\d{{1,3}}(?::\d{{1,5}})?|[A-Za-z0-9\-]{{1,24}}(?:\.[A-Za-z0-9\-]{{1,24}})*\.[a-z]{{2,6}}(?::\d{{1,5}})?|[\w.+\-]+@[A-Za-z0-9.\-]+\.[A-Za-z]{{2,}}|[a-z]{{2,9}}://[^@]+"
    rf"|[.~]{{0,2}}/?{_STEP}(?:/{_STEP})+/?|\d{{1,4}}[\-./]\d{{1,2}}[\-./]\d{{1,4}}(?:[T:]?[\d:.+\-]*Z?)|[vV]?\d{{1,4}}(?:\.\d{{1,6}})+(?:[\-+.][a-z]+\.?\d*)?)[.:]?"
)
_WORDS = re.compile(r"[^\W\d_]{3,}")
FEATURES = ("length", "entropy", "digits", "upper", "lower", "others", "changes", "digit_changes", "vowel_changes", "covered", "keyword", "assigned", "quoted", "sample_path", "config_path", "known_left", "known_right", "prefixed", "ordinary")


def _assigned(text: str) -> list[tuple[int, int, int]]:
    """Place of each value assigned to a credential's name, and where the name starts."""
    found = []
    for m in _VALUE.finditer(text):
        i, j = m.span(m.lastgroup)
        if m.lastgroup == "d":
            if m["by"] != "=" and j > i + 1 and text[j - 1] == "." and not text[j : j + 1].strip():
                j -= 1  # the end of a sentence
            while j > i + 1 and text[j - 1] in ")]}" and text.count("([{"[")]}".index(text[j - 1])], i, j) < text.count(text[j - 1], i, j):
                j -= 1
        found.append((i, j, m.start()))
    return found


def _key_blocks(text: str) -> list[tuple[int, int]]:
    """Places of private keys over several lines, of any length: from a beginning to the end that follows it, with nothing
    but a key's characters between them."""
    found, begun = [], None
    for m in _KEY_EDGE.finditer(text):
        if m["begin"]:
            begun = m
        elif begun and _KEY_BODY.fullmatch(text, begun.end(), m.start()):
            found.append((begun.start(), m.end()))
            begun = None
    return found


def _runs(text: str):
    """Places of runs of at least 12 characters with a digit, or from a known prefix on, in one pass."""
    for m in _RUN.finditer(text):
        start, end = m.span()
        if not _DIGIT.search(text, start, end):
            known = next((x for x in _KNOWN.finditer(m[0]) if len(m[0]) - x.start() >= 12), None)
            if known is None:
                continue
            start += known.start()
        padded = _PADDING.match(text, end)
        yield start, padded.end() if padded else end


def candidates(text: str | None) -> list[tuple[int, int]]:
    """Places of the candidates: private keys over several lines, whatever is assigned to a credential's name or is the
    password of an address, and other runs of at least 12 characters of names, numbers and encodings with a digit."""
    if not text:
        return []
    blocks = _key_blocks(text) if "PRIVATE KEY" in text else []
    assigned, found, k = _assigned(text), [], 0
    if "://" in text:
        assigned = sorted(assigned + [(*m.span("a"), m.start()) for m in _USER.finditer(text)])
    for start, end in _runs(text):
        while k < len(assigned) and assigned[k][1] <= start:
            k += 1
        # A value and its name are one finding, the value.
        if k == len(assigned) or start < assigned[k][2] or end <= assigned[k][0]:
            found.append((start, end))
        elif end > assigned[k][1] and len(rest := text[assigned[k][1] : end]) >= 12 and any(map(str.isdigit, rest)):
            found.append((assigned[k][1], end))
    found += [(i, j) for i, j, _ in assigned]
    if blocks:
        begins = [i for i, _ in blocks]
        last = lambda x: blocks[k - 1] if (k := bisect.bisect_left(begins, x[1])) else (0, 0)
        found = [x for x in found if last(x)[1] <= x[0]] + blocks
    return sorted(set(found))


def _kind(c: str) -> int:
    return 0 if c.isdigit() else 1 if c.islower() else 2 if c.isupper() else 3


def finding_features(text: str, start: int, end: int, path: str | None, common: frozenset[str]) -> list[float]:
    word = text[start:end]
    left, right = text[max(0, start - CONTEXT) : start], text[end : end + CONTEXT]
    n, kinds = len(word), [_kind(c) for c in word]
    shares = [kinds.count(k) / n for k in range(4)]
    entropy = -sum(p * math.log2(p) for p in (word.count(c) / n for c in set(word)))
    pairs = list(zip(kinds, kinds[1:], strict=False))
    vowel = [c in "aeiouAEIOU" for c in word]
    covered = sum(len(x) for x in _WORDS.findall(word) if x.lower() in common) / n
    known = lambda side: (sum(x.lower() in common for x in side) / len(side)) if side else 0.0
    return [
        float(n), entropy, shares[0], shares[2], shares[1], shares[3],
        sum(a != b for a, b in pairs) / max(1, n - 1), sum((a == 0) != (b == 0) for a, b in pairs) / max(1, n - 1), sum(a != b for a, b in zip(vowel, vowel[1:], strict=False)) / max(1, n - 1),
        covered, float(bool(_KEYWORD.search(left))), float(bool(_ASSIGNED.search(left))), float(left[-1:] in "\"'`" and right[:1] in "\"'`" and bool(left)),
        float(bool(_SAMPLE.search(path or ""))), float(bool(_CONFIG.search(path or ""))), known(_WORDS.findall(left)), known(_WORDS.findall(right)),
        float(bool(_PREFIXED.fullmatch(word) or _key_blocks(word) == [(0, n)])), float(bool(_ORDINARY.fullmatch(word))),
    ]


@dataclass
class Forest:
    cuts: list[np.ndarray]
    #: Trees as nested (feature, bin, left, right), or a leaf's share of secrets.
    trees: list

    def score(self, x: np.ndarray) -> np.ndarray:
        """Share of secrets in the leaves that each row of features falls in, averaged over the trees."""
        b, out = binned(x, self.cuts), np.zeros(len(x))

        def walk(node, rows):
            if not isinstance(node, tuple):
                out[rows] += node
            elif len(rows):
                goes = b[rows, node[0]] < node[1]
                walk(node[2], rows[goes])
                walk(node[3], rows[~goes])

        for tree in self.trees:
            walk(tree, np.arange(len(x)))
        return out / max(1, len(self.trees))


def fit_forest(x: np.ndarray, y: np.ndarray, trees: int = 40, depth: int = 8, seed: int = 7) -> Forest:
    """A random forest: bootstrapped rows, a random third of the features at each split, Gini impurity. Without rows it
    scores 0.5."""
    rng, cuts = np.random.default_rng(seed), quantile_cuts(x, 32) if len(x) else [np.zeros(0)] * len(FEATURES)
    if not len(x):
        return Forest(cuts, [0.5])
    b, tries = binned(x, cuts), max(1, x.shape[1] // 3)

    def grow(rows: np.ndarray, left: int):
        share = float(y[rows].mean())
        if not left or len(rows) < 4 or share in (0.0, 1.0):
            return share
        best = (0.0, 0, 0)
        for j in rng.choice(x.shape[1], tries, replace=False):
            n = np.cumsum(np.bincount(b[rows, j], minlength=len(cuts[j]) + 1))[:-1]
            s = np.cumsum(np.bincount(b[rows, j], y[rows], len(cuts[j]) + 1))[:-1]
            m, t = len(rows) - n, y[rows].sum() - s
            with np.errstate(all="ignore"):
                gain = np.nan_to_num(s * s / n) + np.nan_to_num(t * t / m) - len(rows) * share**2
            gain[(n == 0) | (m == 0)] = 0
            if len(gain) and gain.max() > best[0] + 1e-12:
                best = (float(gain.max()), int(j), int(gain.argmax()) + 1)
        if not best[0]:
            return share
        goes = b[rows, best[1]] < best[2]
        return best[1], best[2], grow(rows[goes], left - 1), grow(rows[~goes], left - 1)

    return Forest(cuts, [grow(rng.integers(0, len(x), len(x)), depth) for _ in range(trees)])


def common_words(docs: DataFrame, size: int = DICTIONARY) -> frozenset[str]:
    """The ``size`` words of letters that the most documents of ``docs`` (text) hold, in lower case; at most ``size``
    rows reach the driver."""
    word = F.explode(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"[\p{L}]{3,}"), F.lit(0)))).alias("word")
    top = docs.select(word).groupBy("word").count().orderBy(F.desc("count"), "word").limit(size)
    return frozenset(r["word"] for r in top.collect())


def _measured(docs: DataFrame, common: frozenset[str]) -> DataFrame:
    """A row for each candidate of ``docs`` (doc_id, text, path): doc_id, start, length, sha256, x."""

    def find(batches):
        import pyarrow as pa

        for batch in batches:
            rows = []
            for doc_id, text, path in zip(batch.column("doc_id").to_pylist(), batch.column("text"), batch.column("path").to_pylist(), strict=True):
                text = text.as_py()
                for i, j in candidates(text):
                    rows.append({"doc_id": doc_id, "start": i, "length": j - i, "sha256": hashlib.sha256(text[i:j].encode()).hexdigest(), "x": finding_features(text, i, j, path, common)})
            yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([("doc_id", pa.int64()), ("start", pa.int32()), ("length", pa.int32()), ("sha256", pa.string()), ("x", pa.list_(pa.float64()))]))

    return docs.select("doc_id", "text", "path").mapInArrow(find, "doc_id long, start int, length int, sha256 string, x array<double>")


def train(findings: DataFrame, max_findings: int = MAX_FINDINGS) -> Forest:
    """A forest from labelled ``findings`` (doc_id, start, x, is_secret); rows with a null label are left out. At most
    ``max_findings`` are used and sent to the driver."""
    usable = findings.where(F.col("is_secret").isNotNull())
    rows = usable.orderBy(F.xxhash64("doc_id", "start"), "doc_id", "start").limit(max_findings).select("x", F.col("is_secret").cast("int").alias("y")).toArrow()
    x = np.array(rows.column("x").to_pylist(), float).reshape(-1, len(FEATURES))
    y = rows.column("y").to_numpy().astype(float)
    order = np.lexsort((*x.T, y))
    return fit_forest(x[order], y[order])


def scan(docs: DataFrame, forest: Forest, common: frozenset[str], threshold: float = 0.5) -> DataFrame:
    """doc_id, start, length, sha256, score, is_secret for each candidate of ``docs`` (doc_id, text, path): where it lies
    in code points, a digest in its place, and what the forest says.

    Null and empty texts have no candidate; null ids and repeated rows are kept; a null path is an empty one; further
    columns are ignored; an empty table gives an empty result.
    """
    @F.pandas_udf("double")
    def score(x: pd.Series) -> pd.Series:
        return pd.Series(forest.score(np.array(x.tolist(), float).reshape(-1, len(FEATURES))))

    found = _measured(docs, common).withColumn("score", score("x"))
    return found.select("doc_id", "start", "length", "sha256", "score", (F.col("score") >= threshold).alias("is_secret"))


def _planted_value(rng: random.Random) -> tuple[str, str, str, bool]:
    """What stands before a value, the value, what stands behind it, and whether it is a secret."""
    letters, digits = "abcdefghijklmnopqrstuvwxyz", "0123456789"
    some = lambda alphabet, n: "".join(rng.choices(alphabet, k=n))
    alnum, hexes = letters + letters.upper() + digits, "0123456789abcdef"
    base64 = alnum + "+/"
    word = lambda: some(letters, rng.randint(3, 9))
    mixed = lambda n: f"{some(letters, 2)}{some(letters.upper(), 2)}{some(digits, 2)}{some(alnum, n)}"
    name = rng.choice(["token", "secret", "password", "passwd", "api_key", "apikey", "access_key", "API_KEY", "auth_token", "client_secret"])
    before, behind = rng.choice([(f'{name} = "', '"'), (f"{name}=", ""), (f"{name}: ", ""), (f"'{name}': '", "'"), (f"export {name.upper()}=", ""), (f"?{name}=", "")])
    secret = rng.random() < 0.5
    if secret:
        known = rng.choice([
            lambda: "ghp_" + some(alnum, 36), lambda: "AKIA" + some(letters.upper() + digits, 16), lambda: "xoxb-" + some(digits, 11) + "-" + some(alnum, 24), lambda: "sk_live_" + some(alnum, 24),
            lambda: "glpat-" + some(alnum, 20), lambda: f"eyJ{some(alnum, 20)}.eyJ{some(alnum, 40)}.{some(alnum, 43)}", lambda: some(base64, rng.choice([40, 44, 64])), lambda: mixed(rng.randint(20, 40)),
        ])
        weak = lambda: word() + rng.choice("!#-_.@") + word().title() + some(digits, rng.randint(0, 4))
        kind = rng.randrange(5)
        if kind == 0:
            return rng.choice(["", "uses ", "("]), known(), rng.choice(["", " now", ")"]), True
        if kind == 1:
            return "", "-----BEGIN RSA PRIVATE KEY-----\n" + "\n".join(some(base64, 64) for _ in range(rng.randint(3, 12))) + "\n-----END RSA PRIVATE KEY-----", "", True
        if kind == 2:
            return f"{rng.choice(['https', 'postgres', 'amqp'])}://{word()}:", mixed(rng.randint(4, 12)), f"@{word()}.example.com/{word()}", True
        return before, rng.choice([known, lambda: some(hexes, rng.choice([32, 40, 64])), lambda: mixed(rng.randint(8, 20)), weak])(), behind, True
    kind = rng.randrange(8)
    if kind == 0:  # what stands in a secret's place in examples
        value = rng.choice(["your-token-here", "changeme", "<token>", "${" + name.upper() + "}", "xxxxxxxxxxxxxxxx", "********", "null", "None", "required", "REPLACE_ME_123456", "os.environ", word(), "example-" + word()])
        return before, value, behind, False
    if kind == 1:
        return rng.choice(["commit ", "sha256:", "revision ", "checksum ", "md5 "]), some(hexes, rng.choice([32, 40, 64])), "", False
    value = [
        lambda: f"/{word()}/{word()}{some(digits, 2)}/{word()}.{rng.choice(['py', 'txt', 'json'])}", lambda: f"{word()}{some(digits, 1)}.{word()}.example.com:{some(digits, 4)}", lambda: f"{word()}.{word()}{some(digits, 2)}@{word()}.example.org",
        lambda: f"20{some(digits, 2)}-0{rng.randint(1, 9)}-{rng.randint(10, 28)}T{rng.randint(10, 23)}:{rng.randint(10, 59)}:{rng.randint(10, 59)}Z", lambda: some("123456789", 1) + some(digits, rng.randint(12, 18)), lambda: f"{some(hexes, 8)}-{some(hexes, 4)}-4{some(hexes, 3)}-a{some(hexes, 3)}-{some(hexes, 12)}",
    ][kind - 2]()
    return rng.choice(["", "see ", "id ", "at ", "file "]), value, "", False


def planted(text: str, rng: random.Random, plants: int = PLANTS) -> tuple[str, list[tuple[int, int, bool]]]:
    """The text with secrets and look-alikes put between its words, and their places: start, end, is_secret."""
    words, out, found, at = text.split(" "), [], [], 0
    places = set(rng.sample(range(len(words)), min(plants, len(words))))
    for k, word in enumerate(words):
        if k in places:
            before, value, behind, secret = _planted_value(rng)
            found.append((at + len(before), at + len(before) + len(value), secret))
            out.append(before + value + behind)
            at += len(out[-1]) + 1
        out.append(word)
        at += len(word) + 1
    return " ".join(out), found


def planted_findings(docs: DataFrame, common: frozenset[str], passages: int = MAX_PASSAGES, seed: int = 7) -> DataFrame:
    """Labelled findings (doc_id, start, length, x, is_secret) planted into passages of ``docs`` (doc_id, text, path).

    ``passages`` bounds how many documents give a passage, those of the smallest hash; what the documents themselves hold
    has no label and is left out. Null texts give none.
    """
    h = F.xxhash64("doc_id", "text", F.lit(seed))
    at = 1 + F.pmod(h, F.greatest(F.length("text") - PASSAGE, F.lit(1)))
    known = docs.where(F.col("text").isNotNull()).withColumn("h", h)
    # The hashes are chosen first, so that a task hands on no passage but those wanted; rows with one hash are equal texts of one id.
    chosen = known.select("h").distinct().orderBy("h").limit(passages)
    some = known.join(F.broadcast(chosen), "h").select("h", F.struct("doc_id", "path", F.substring("text", at.cast("int"), F.lit(PASSAGE)).alias("text")).alias("of"))
    some = some.groupBy("h").agg(F.min("of").alias("of")).select("of.*", "h")

    def plant(batches):
        import pyarrow as pa

        for batch in batches:
            rows = []
            for doc_id, text, path, h in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "path", "h")), strict=True):
                text, labels = planted(text, random.Random(h))
                proposed = set(candidates(text))
                rows += [{"doc_id": doc_id, "start": i, "length": j - i, "x": finding_features(text, i, j, path, common), "is_secret": secret} for i, j, secret in labels if (i, j) in proposed]
            yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([("doc_id", pa.int64()), ("start", pa.int32()), ("length", pa.int32()), ("x", pa.list_(pa.float64())), ("is_secret", pa.bool_())]))

    return some.mapInArrow(plant, "doc_id long, start int, length int, x array<double>, is_secret boolean")


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Findings of all documents, the source standing for the path. No table has labelled findings, so the forest is
    trained on findings planted into passages of documents that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", F.col("source").alias("path"))
    common = common_words(docs)
    return scan(docs, train(planted_findings(docs.where(~held_out(F.col("doc_id"))), common)), common)
