"""URL filter: a bit-parallel wildcard automaton over canonical URLs.

Rules are globs over ``host + path`` (host lower-cased, no scheme, query or fragment). ``*`` matches any run of
characters other than ``/``, ``**`` any run at all, ``?`` one character other than ``/``. All globs are packed into
Shift-And masks of several 64-bit words; one step per character moves every glob of every URL of a batch at once:
``D = ((D << 1) & B[c]) | (D & L[c])`` where B marks states entered by c and L states that loop on c.

A URL's verdict is that of its longest matching rule (the first one of equal length), else that of the longest
matching glob of the method's own list, else ``allow``. A null URL, or one without ``://``, has an empty host and path,
which matches only globs that accept empty text. Rows are never dropped; repeated rows are judged alike; extra columns
stay, whatever their names, unless they carry a result's name, which the result then replaces.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ROWS_AT_ONCE = 4096


@dataclass(frozen=True)
class Rule:
    """A rule on a host with all its subdomains and a path prefix."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path

    def globs(self) -> tuple[str, str]:
        return f"{self.host}{self.path}**", f"*.{self.host}{self.path}**"


# Fixed rules of the production list.
RULES = (
    Rule("allow", "com", "/"), Rule("block", "example.com", "/en/"), Rule("allow", "www.example.com", "/en/"),
    Rule("block", "net", "/es/"), Rule("block", "net", "/fr/"),
)
# The method's own globs for URLs that no rule decides: advertising and tracking hosts, and programs to download.
METHOD_GLOBS = (("block", "*ads-track.**"), ("block", "**/**.exe"))


@dataclass(frozen=True)
class Automaton:
    """Masks by byte: enter[c], loop[c]; start and the final bit of each glob."""

    enter: np.ndarray
    loop: np.ndarray
    start: np.ndarray
    final: np.ndarray


def compile_globs(globs: list[str]) -> Automaton:
    """State 0 of a glob is its start; each character or ``?`` adds a state; a wildcard makes its state loop."""
    parsed = []
    for glob in globs:
        data, steps, loops, i = glob.encode(), [], {}, 0
        while i < len(data):
            if data[i : i + 2] == b"**":
                loops[len(steps)] = "any"
                i += 2
            elif data[i] == ord("*"):
                loops.setdefault(len(steps), "part")
                i += 1
            else:
                steps.append(data[i])
                i += 1
        parsed.append((steps, loops))
    bits = sum(len(steps) + 1 for steps, _ in parsed)
    width = max(1, -(-bits // 64))
    enter, loop = np.zeros((256, width), np.uint64), np.zeros((256, width), np.uint64)
    start, final, at = np.zeros(width, np.uint64), np.zeros((len(globs), 2), np.int64), 0
    slash = ord("/")
    for k, (steps, loops) in enumerate(parsed):
        start[at // 64] |= np.uint64(1 << (at % 64))
        for state, kind in loops.items():
            word, bit = divmod(at + state, 64)
            loop[:, word] |= np.uint64(1 << bit)
            if kind == "part":
                loop[slash, word] &= ~np.uint64(1 << bit)
        for state, byte in enumerate(steps, 1):
            word, bit = divmod(at + state, 64)
            if byte == ord("?"):
                enter[:, word] |= np.uint64(1 << bit)
                enter[slash, word] &= ~np.uint64(1 << bit)
            else:
                enter[byte, word] |= np.uint64(1 << bit)
        final[k] = divmod(at + len(steps), 64)
        at += len(steps) + 1
    return Automaton(enter, loop, start, final)


def simulate(machine: Automaton, texts: list[bytes]) -> np.ndarray:
    """Boolean (text, glob): which globs accept which texts."""
    order = np.argsort([-len(x) for x in texts], kind="stable")
    sizes = np.array([len(texts[i]) for i in order], np.int64)
    joined = np.frombuffer(b"".join(texts[i] for i in order), np.uint8)
    first = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64)
    state = np.tile(machine.start, (len(texts), 1))
    one, top = np.uint64(1), np.uint64(63)
    live = len(texts)
    for step in range(int(sizes[0]) if len(sizes) else 0):
        while sizes[live - 1] <= step:
            live -= 1
        c = joined[first[:live] + step]
        now = state[:live]
        moved = now << one
        moved[:, 1:] |= now[:, :-1] >> top
        state[:live] = (moved & machine.enter[c]) | (now & machine.loop[c])
    hit = (state[:, machine.final[:, 0]] >> machine.final[:, 1].astype(np.uint64)) & one
    out = np.empty((len(texts), len(machine.final)), bool)
    out[order] = hit.astype(bool)
    return out


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def judge_urls(df: DataFrame, url: str = "url", rules: tuple[Rule, ...] = RULES,
               method_globs: tuple[tuple[str, str], ...] = METHOD_GLOBS) -> DataFrame:
    """Add host, path, rule and verdict. One pass, no exchange; the automaton's size depends on the rules alone."""
    globs, owner = [], []
    for k, rule in enumerate(rules):
        for glob in rule.globs():
            globs.append(glob)
            owner.append(k)
    for k, (_, glob) in enumerate(method_globs):
        globs.append(glob)
        owner.append(len(rules) + k)
    # Best first: rules before the method's globs, longer before shorter, earlier before later.
    rank = sorted(range(len(rules)), key=lambda k: (-len(rules[k].name), k))
    rank += [len(rules) + k for k in sorted(range(len(method_globs)), key=lambda k: (-len(method_globs[k][1]), k))]
    columns = [[g for g, o in enumerate(owner) if o == k] for k in rank]
    names = [rules[k].name if k < len(rules) else None for k in rank] + [None]
    verdicts = [rules[k].verdict if k < len(rules) else method_globs[k - len(rules)][0] for k in rank] + ["allow"]
    machine = compile_globs(globs)

    @F.pandas_udf("rule string, verdict string")
    def judged(canonical: pd.Series) -> pd.DataFrame:
        best = np.full(len(canonical), len(columns))
        for at in range(0, len(canonical), ROWS_AT_ONCE):
            texts = [x.encode("utf-8", "surrogatepass") for x in canonical.iloc[at : at + ROWS_AT_ONCE]]
            hits = simulate(machine, texts)
            place = best[at : at + ROWS_AT_ONCE]
            for k in reversed(range(len(columns))):
                place[hits[:, columns[k]].any(axis=1)] = k
        return pd.DataFrame({"rule": [names[k] for k in best], "verdict": [verdicts[k] for k in best]})

    out = df.withColumns({"host": host_of(F.col(url)), "path": path_of(F.col(url))})
    found = judged(F.concat("host", "path"))
    return out.withColumn("__judged", found).withColumns(
        {"rule": F.col("__judged.rule"), "verdict": F.col("__judged.verdict")}).drop("__judged")
