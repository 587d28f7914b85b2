"""URL filter: a bit-parallel wildcard automaton over canonical URLs.

All rules are laid end to end in one bit vector of 64-bit words (multiword Shift-And).  One step over
one character moves every rule at once: ``D = ((D << 1) | (D & stay)) & mask[char]``, and a batch of
URLs is stepped together with numpy.

Site rules are asked of ``.`` + host (A-Z lower-cased) + path: a rule for ``com`` is ``*.com`` and
fits the host and all its subdomains, and a path is matched by prefix.  The longest fitting site rule
decides; ties go to the first in the list.

Where no site rule fits, the method's own globs judge the whole canonical URL, with its query: ``block``
if one fits, else ``allow``.  They are data, in ``url_globs.txt`` unless given.  ``*`` stands for any run
without ``/`` and ``?``, so in a host it never leaves the host; ``**`` stands for any run.  A glob that
has been reached stays reached.

Edge cases: a null url, or one without ``://``, has an empty host and path, no rule and no glob fits
it, and it is allowed.  Very long urls are read whole; those of a batch are stepped longest first, so
one costs no more than its own length.  Repeated rows get equal results, a null page_id stays null.
Columns of any other name are not read.  An empty table gives none.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache
from importlib import resources

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower


@dataclass(frozen=True)
class SiteRule:
    """Fits ``host``, its subdomains, and every path that starts with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path

    @property
    def glob(self) -> str:
        return f"*.{self.host}{self.path}"


#: Fixed values of the contract.
SITE_RULES = (
    SiteRule("allow", "com", "/"),
    SiteRule("block", "example.com", "/en/"),
    SiteRule("allow", "www.example.com", "/en/"),
    SiteRule("block", "net", "/es/"),
    SiteRule("block", "net", "/fr/"),
)


@lru_cache(maxsize=1)
def given_globs() -> tuple[str, ...]:
    """The globs of ``url_globs.txt``, which lies beside this module."""
    lines = (resources.files(__package__) / "url_globs.txt").read_text().splitlines()
    return tuple(line.strip() for line in lines if line.strip() and not line.startswith("#"))


class GlobAutomaton:
    """Simulates all globs at once.  Globs match from the start; what follows their end is free."""

    def __init__(self, globs: Sequence[str]) -> None:
        first, last, literal, loops = [], [], [], []
        for glob in globs:
            if not glob.strip("*"):
                raise ValueError("a glob needs a character other than *")
            first.append(len(literal))
            stars = 0
            for char in glob.encode("utf-8").decode("latin-1"):
                if char == "*":
                    stars += 1
                    continue
                # The loop sits before the character: the state that waits for it.
                loops.append(min(stars, 2))
                literal.append(ord(char))
                stars = 0
            last.append(len(literal) - 1)
        self.n_words = (len(literal) + 63) // 64
        bits = lambda positions: self._pack(positions)
        self.masks = np.zeros((256, self.n_words), np.uint64)
        for code in set(literal):
            self.masks[code] = bits([k for k, c in enumerate(literal) if c == code])
        #: States that wait: bit k is on while the automaton may next read literal k.
        self.start = bits(first)
        self.loops = bits([k for k, x in enumerate(loops) if x])
        self.wide = bits([k for k, x in enumerate(loops) if x == 2])
        self.final = bits(last)
        self.last = last

    def _pack(self, positions: Sequence[int]) -> np.ndarray:
        out = np.zeros(self.n_words, np.uint64)
        for k in positions:
            out[k >> 6] |= np.uint64(1 << (k & 63))
        return out

    def match(self, urls: Sequence[bytes]) -> np.ndarray:
        """A row of booleans for each url: which globs match."""
        hit = np.zeros((len(urls), self.n_words), np.uint64)
        size = np.fromiter(map(len, urls), np.int64, len(urls))
        # Longest first, so the urls still being read are a prefix of the array.
        order = np.argsort(-size, kind="stable")
        flat = np.frombuffer(b"".join(urls), np.uint8)
        begin = (np.cumsum(size) - size)[order]
        size = size[order]
        wait = np.repeat(self.start[None, :], len(urls), axis=0)
        one, top = np.uint64(1), np.uint64(63)
        narrow = np.ones(256, bool)
        narrow[[ord("/"), ord("?")]] = False
        for j in range(int(size[0]) if len(size) else 0):
            live = int(np.searchsorted(-size, -j, side="left"))
            chars = flat[begin[:live] + j]
            w = wait[:live]
            read = w & self.masks[chars]
            hit[order[:live]] |= read & self.final
            moved = read & ~self.final
            carry = np.zeros_like(moved)
            carry[:, 1:] = moved[:, :-1] >> top
            moved = (moved << one) | carry
            wait[:live] = moved | (w & np.where(narrow[chars][:, None], self.loops, self.wide))
        ends = np.array(self.last, np.int64)
        return ((hit[:, ends >> 6] >> (ends & 63).astype(np.uint64)) & one).astype(bool)


def canonical(host: Column, path: Column, rest: Column) -> Column:
    """What globs are asked of; ``rest`` is the url after its ``://``."""
    query = F.regexp_extract(rest, r"^[^?#]*([?][^#]*)", 1)
    return F.concat(F.lit("."), host, F.when(path == "", F.lit("/")).otherwise(ascii_lower(path)), ascii_lower(query))


def judge(pages: DataFrame, rules: Sequence[SiteRule] = SITE_RULES, globs: Sequence[str] | None = None, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """page_id, host, path, rule, verdict and by (``rule``, ``glob`` or ``default``) for every row; no shuffle."""
    url = F.coalesce(pages[url_col].cast("string"), F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host, path = ascii_lower(F.regexp_extract(rest, r"^([^/?#]*)", 1)), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    parts = pages.select(pages[id_col].alias("page_id"), host.alias("host"), path.alias("path"), canonical(host, path, rest).alias("_whole"), (at > 0).alias("_url"))
    rules, globs = tuple(rules), given_globs() if globs is None else tuple(globs)
    schema = f"page_id {parts.schema['page_id'].dataType.simpleString()}, host string, path string, rule string, verdict string, by string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sites, others = GlobAutomaton([r.glob for r in rules]), GlobAutomaton(globs)
        length = np.array([len(r.name) for r in rules])
        names = np.array([r.name for r in rules] + [None], object)
        verdicts = np.array([r.verdict for r in rules], object)
        for batch in batches:
            host, path, is_url = batch["host"].to_pylist(), batch["path"].to_pylist(), np.array(batch["_url"].to_pylist(), bool)
            found = sites.match([f".{h}{p}".encode() for h, p in zip(host, path, strict=True)]) & is_url[:, None]
            score = np.where(found, length, -1)
            best = score.argmax(axis=1) if len(rules) else np.zeros(len(host), int)
            ruled = score.max(axis=1, initial=-1) >= 0
            # Only urls that no rule covers meet the globs.
            bad = np.zeros(len(host), bool)
            asked = np.flatnonzero(is_url & ~ruled)
            bad[asked] = others.match([batch["_whole"][k].as_py().encode() for k in asked.tolist()]).any(axis=1)
            verdict = np.where(ruled, verdicts[best] if len(rules) else None, np.where(bad, "block", "allow"))
            by = np.where(ruled, "rule", np.where(bad, "glob", "default"))
            yield pa.RecordBatch.from_arrays(
                [batch["page_id"], batch["host"], batch["path"], *(pa.array(list(x), pa.string()) for x in (names[np.where(ruled, best, len(rules))], verdict, by))],
                names=["page_id", "host", "path", "rule", "verdict", "by"],
            )

    return parts.mapInArrow(run, schema)
