"""URL filters: rules found through their rarest literal token.

A rule is either a host with a path prefix, or a glob pattern over the whole
URL. A URL that fits must contain the rule's literal tokens (runs of ASCII
letters and digits), so the rule is filed under the one that is rarest over all
URLs; a URL's tokens fetch candidate rules, and only those run their regular
expression. A pattern's token that may go on at one end or both is a beginning,
end or inner part of a URL's token, and is asked for as such.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, replace

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import LOWER, UPPER, lower_ascii, slices

TOKEN = re.compile("[a-z0-9]+")
#: Rules that travel to the executors in one pass (a few hundred bytes each);
#: more rules take more passes over the URLs.
RULES_A_PASS = 100_000
#: Kinds of token parts, written before a part to tell it from a whole token.
BEGINS, ENDS, INSIDE = "<", ">", "*"
TO_LOWER = str.maketrans(UPPER, LOWER)


@dataclass(frozen=True)
class HostRule:
    """Fits its host and all subdomains where the path starts with ``path``."""

    action: str
    host: str
    path: str = "/"

    @property
    def text(self) -> str:
        return self.host + self.path

    @property
    def regex(self) -> str:
        return rf"(?s)(?:[^/]*\.)?{re.escape(self.host)}{re.escape(self.path)}"

    @property
    def tokens(self) -> set[str]:
        """A path that ends within a word may go on, so its last word is no token."""
        whole = re.sub("[a-z0-9]+$", "", self.path.translate(TO_LOWER))
        return set(TOKEN.findall(self.host.translate(TO_LOWER))) | set(TOKEN.findall(whole))

    over_url = False


@dataclass(frozen=True)
class PatternRule:
    """A glob: ``*`` stands for any characters. Without ``*`` at either end,
    both ends fall on token borders, unless the rule is ``anywhere``. Matched
    anywhere in the URL with A-Z lower-cased."""

    action: str
    pattern: str
    anywhere: bool = False

    @property
    def text(self) -> str:
        return self.pattern

    @property
    def regex(self) -> str:
        parts = [re.escape(p) for p in self.pattern.translate(TO_LOWER).split("*")]
        return rf"(?s).*?(?<![a-z0-9]){'.*'.join(parts)}(?![a-z0-9])" if not self.anywhere and "*" not in (
            self.pattern[:1], self.pattern[-1:]) else "(?s).*?" + ".*".join(parts)

    @property
    def tokens(self) -> set[str]:
        text = self.pattern.translate(TO_LOWER)
        open_ends = self.anywhere or text[:1] == "*" or text[-1:] == "*"
        keys = set()
        for m in TOKEN.finditer(text):
            before = text[m.start() - 1:m.start()] == "*" or open_ends and m.start() == 0
            after = text[m.end():m.end() + 1] == "*" or open_ends and m.end() == len(text)
            keys.add((INSIDE if before and after else ENDS if before else BEGINS if after else "") + m[0])
        return keys

    over_url = True


def _lengths(keys: Iterable[str]) -> dict[str, list[int]]:
    """Lengths of the token parts among keys, by their kind."""
    return {kind: sorted({len(k) - 1 for k in keys if k[:1] == kind}) for kind in (BEGINS, ENDS, INSIDE)}


def _asked(tokens: set[str], lengths: dict[str, list[int]]) -> set[str]:
    """The keys that a URL's tokens fetch rules by: the tokens, and of each
    the parts of the lengths that rules are filed under."""
    keys = {"", *tokens}
    for t in tokens:
        keys.update(BEGINS + t[:n] for n in lengths[BEGINS] if n <= len(t))
        keys.update(ENDS + t[-n:] for n in lengths[ENDS] if n <= len(t))
        keys.update(INSIDE + t[i:i + n] for n in lengths[INSIDE] for i in range(len(t) - n + 1))
    return keys


def token_counts(urls: DataFrame, url_col: str, wanted: set[str]) -> dict[str, int]:
    """Over all URLs, how many have each of the rules' tokens and parts of
    tokens. The result has a row for each key of the rules at most."""
    tokens = F.array_distinct(F.split(lower_ascii(F.col(url_col).cast("string")), "[^a-z0-9]+"))
    lengths = _lengths(wanted)

    def inner(t, n):
        starts = F.when(F.length(t) >= n, F.sequence(F.lit(1), F.length(t) - (n - 1))).otherwise(
            F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.concat(F.lit(INSIDE), F.substring(t, i, F.lit(n))))

    def parts(t):
        return F.concat(F.array(t, *(F.concat(F.lit(BEGINS), F.left(t, F.lit(n))) for n in lengths[BEGINS]),
                                *(F.concat(F.lit(ENDS), F.right(t, F.lit(n))) for n in lengths[ENDS])),
                        *(inner(t, n) for n in lengths[INSIDE]))

    keys = F.explode(F.array_distinct(F.flatten(F.transform(tokens, parts))))
    spark = urls.sparkSession
    asked = spark.createDataFrame([(t,) for t in sorted(wanted)], "token string")
    asked = F.broadcast(asked) if len(wanted) <= RULES_A_PASS else asked
    counted = urls.select(keys.alias("token")).join(asked, "token", "left_semi").groupBy("token").count()
    return {r["token"]: r["count"] for r in counted.collect()}


def index_rules(rules: list, counts: dict[str, int]) -> dict[str, list]:
    """Rules by their rarest literal token or part of one, of equally rare
    ones a whole token; ``""``: rules without a letter or digit."""
    index = defaultdict(list)
    for rule in rules:
        rarest = min(rule.tokens, key=lambda t: (counts.get(t, 0), t[:1] in (BEGINS, ENDS, INSIDE), t), default="")
        index[rarest].append(rule)
    return dict(index)


def split_url(url: str | None) -> tuple[str, str]:
    """Host (A-Z lower-cased) and path; both empty without ``://``."""
    _, found, rest = (url or "").partition("://")
    if not found:
        return "", ""
    host = re.split("[/?#]", rest, maxsplit=1)[0]
    return host.translate(TO_LOWER), re.split("[?#]", rest[len(host):], maxsplit=1)[0]


def _judge(index: dict[str, list], smaller: bool):
    def judge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compiled = {r: re.compile(r.regex) for rules in index.values() for r in rules}
        rank = lambda r: (len(r.text), r.action == "block")
        lengths = _lengths(index)
        better = lambda a, b: b if a is None or rank(b) > rank(a) or rank(b) == rank(a) and (
            b.text < a.text if smaller else b.text > a.text) else a
        for batch in slices(batches, "__url"):
            hosts, paths, found = [], [], {"rule": [], "action": [], "pattern": [], "pattern_action": []}
            for url in batch.column("__url").to_pylist():
                host, path = split_url(url)
                low = (url or "").translate(TO_LOWER)
                best = {False: None, True: None}
                for key in _asked(set(TOKEN.findall(low)), lengths):
                    for rule in index.get(key, ()):
                        if compiled[rule].match(low if rule.over_url else host + path):
                            best[rule.over_url] = better(best[rule.over_url], rule)
                hosts.append(host)
                paths.append(path)
                for over, name, act in ((False, "rule", "action"), (True, "pattern", "pattern_action")):
                    found[name].append(best[over] and best[over].text)
                    found[act].append(best[over] and best[over].action)
            columns = {n: batch.column(n) for n in batch.schema.names}
            columns |= {"__host": pa.array(hosts, pa.string()), "__path": pa.array(paths, pa.string())}
            columns |= {f"__{n}": pa.array(v, pa.string()) for n, v in found.items()}
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return judge


def judge_urls(pages: DataFrame, host_rules: list[HostRule], pattern_rules: list[PatternRule],
               id_col: str = "page_id", url_col: str = "url", default: str = "allow",
               plain: bool = False) -> DataFrame:
    """One row per row of ``pages``: page_id, host, path, rule (the longest
    host rule that fits, else null), verdict, pattern (the longest pattern
    rule that fits, else null).

    The verdict is the host rule's, else the pattern rule's, else ``default``.
    Of rules of one length a block wins, then the larger text. With ``plain``
    patterns ask for no token borders, and the smaller text wins. A null or empty
    URL, or one without ``://``, has an empty host and path and can only fit
    pattern rules. Repeated rows are judged each by itself; other columns are
    not read; an empty frame gives no rows.
    """
    if plain:
        pattern_rules = [replace(r, anywhere=True) for r in pattern_rules]
    rules = [*dict.fromkeys([*host_rules, *pattern_rules])]
    counts = token_counts(pages, url_col, {t for r in rules for t in r.tokens}) if rules else {}
    names = ("host", "path", "rule", "action", "pattern", "pattern_action")
    out = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("__url"))
    passes = [rules[k:k + RULES_A_PASS] for k in range(0, len(rules), RULES_A_PASS)] or [[]]
    for k, some in enumerate(passes):
        schema = T.StructType([*out.schema.fields, *(T.StructField(f"__{n}", T.StringType()) for n in names)])
        out = out.mapInArrow(_judge(index_rules(some, counts), plain), schema)
        if k:  # the better of this pass and those before
            for name, act in (("rule", "action"), ("pattern", "pattern_action")):
                rank = lambda n, a: F.struct(F.length(n), F.col(a) == "block")
                a, b = rank(name, act), rank(f"__{name}", f"__{act}")
                first = F.col(f"__{name}") < F.col(name) if plain else F.col(f"__{name}") > F.col(name)
                new = F.col(f"__{name}").isNotNull() & (F.col(name).isNull() | (b > a) | ((b == a) & first))
                out = out.withColumns({name: F.when(new, F.col(f"__{name}")).otherwise(F.col(name)),
                                       act: F.when(new, F.col(f"__{act}")).otherwise(F.col(act))})
            out = out.drop(*(f"__{n}" for n in names))
        else:
            out = out.withColumnsRenamed({f"__{n}": n for n in names})
    return out.select("page_id", "host", "path", "rule",
                      F.coalesce("action", "pattern_action", F.lit(default)).alias("verdict"), "pattern")
