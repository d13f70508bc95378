r"""Problem 2: text decoded with the wrong encoding.

Method: expectation-maximization with latent encoding chains. A chain says how a piece of non-ASCII text came about: as it
should, by reading bytes of one encoding as another, once or more often, or with its characters lost. The evidence is the
atom: a single non-ASCII character, or the characters that some code page gives for the bytes of one character in UTF-8,
at any depth of repeated misreading; runs of any length are atoms in a row. An atom is seen with what stands on either
side (an ASCII letter, a figure, a space, another sign, another atom, another atom of UTF-8 shape). One distributed pass
counts atoms over all records of each pool (a source and field); EM over the counts learns how often each chain occurs
in each pool and, from the atoms as repaired, what clean text looks like, so that a weak sign in one record is judged by
all records. A second pass gives every record the posteriors of its atoms, finds the records in which an atom is more
likely garbled than not, and repairs each of their atoms by the chain that the record's posterior favours.

What reaches the driver is the table of distinct atoms: characters of eight code pages and what UTF-8 makes of them, in at
most 57 x 57 neighbourhoods, and other characters without any. It is bounded by alphabets and grows neither with the
number of records nor with the words of a language. The executors add up before anything travels.

Edge cases: NULL and ASCII-only values are never found; U+FFFD always is (clean text has none), and can't be restored; a
tie (posterior 0.5) counts as clean; a no-break space is never told from a misread letter by itself, only by what else
the record holds; equal rows get equal results; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CLEAN, GONE = "clean", "lost"
LOST, TYPED = "\ufffd", "\xa0"
_UNITS = re.compile(r"([\x00-\x7f]?)([^\x00-\x7f]+)(?=([\x00-\x7f]?))")
_UTF8_READ_AS = ("cp1252", "cp437", "cp850", "mac_roman", "cp1251", "cp1250")
_BYTES_READ_AS = (("cp1252", "cp437"), ("cp1252", "cp850"), ("cp1252", "mac_roman"), ("cp1252", "cp1250"), ("cp850", "cp1252"), ("mac_roman", "cp1252"), ("cp1251", "cp1252"), ("koi8_r", "cp1252"))
#: Odds, per sign, of what clean text hardly ever holds: valid UTF-8 by accident (a byte of continuation), C1 control
#: characters, lost characters; and, in the text that was misread, letters of two scripts or characters that no misreading
#: gives side by side with it.
BY_CHANCE, C1_IN_CLEAN, LOST_IN_CLEAN, MIXED = 1e-3, 1e-4, 1e-9, 1e-3
#: The chance of a character that is seen nowhere else.
UNSEEN = 1e-13
#: Distinct runs that a task holds before it turns them into atoms.
HELD = 200_000


def _to_byte(code: str) -> dict[str, int]:
    """Character to byte; bytes that a Windows page leaves undefined stand for themselves, as lenient readers have it."""
    out = {}
    for b in range(0x80, 0x100):
        try:
            out[bytes([b]).decode(code)] = b
        except UnicodeDecodeError:
            out[chr(b)] = b
    if code == "cp1252":  # plain Latin-1 readings leave C1 controls
        out |= {chr(b): b for b in range(0x80, 0xA0)}
    return out


def _from_byte(code: str) -> dict[int, str]:
    out = {}
    for b in range(0x80, 0x100):
        try:
            out[b] = bytes([b]).decode(code)
        except UnicodeDecodeError:
            pass
    return out


_TO = {code: _to_byte(code) for code in _UTF8_READ_AS}
_FROM = {code: _from_byte(code) for code in ("cp1252", "cp850", "mac_roman", "cp1251", "koi8_r")}




def misread(c: str) -> list[str]:
    """What a character looks like when its UTF-8 bytes were read as another encoding, once or twice."""
    out = []
    for code in ("latin-1", *_UTF8_READ_AS):
        back = {b: x for x, b in _TO[code].items() if not (code == "cp1252" and "\x80" <= x <= "\x9f" and b in _FROM["cp1252"])} if code != "latin-1" else {b: chr(b) for b in range(128, 256)}
        out.append("".join(back[b] for b in c.encode()))
    twice = {b: x for b, x in _FROM["cp1252"].items()}
    out.append("".join(twice.get(b, chr(b)) for b in out[1].encode() ))
    return list(dict.fromkeys(out))


_REPERTOIRE = frozenset(c for table in _TO.values() for c in table) | {LOST}


def _shape(read_as: str) -> str:
    """A pattern of characters that read_as gives for the UTF-8 bytes of one character."""
    by = lambda lo, hi: "[" + re.escape("".join(c for c, b in _TO[read_as].items() if lo <= b <= hi)) + "]"
    more = by(0x80, 0xBF)
    return f"{by(0xC2, 0xDF)}{more}|{by(0xE0, 0xEF)}{more}{{2}}|{by(0xF0, 0xF4)}{more}{{3}}"


_SHAPED = re.compile("|".join(map(_shape, _UTF8_READ_AS)))


def _next(run: str, i: int, read_as: str, depth: int) -> tuple[str, int]:
    """The character at place i of run as decoded depth times, and the place behind it."""
    if not depth:
        return run[i], i + 1
    c, end = _next(run, i, read_as, depth - 1)
    table = _TO[read_as if depth == 1 else "cp1252"]
    b = table.get(c, -1)
    k = 2 if 0xC2 <= b <= 0xDF else 3 if 0xE0 <= b <= 0xEF else 4 if 0xF0 <= b <= 0xF4 else 0
    codes, at = [b], end
    while len(codes) < k and at < len(run):
        x, at = _next(run, at, read_as, depth - 1)
        if not 0x80 <= table.get(x, -1) <= 0xBF:
            break
        codes.append(table[x])
    if k and len(codes) == k:
        try:
            return bytes(codes).decode("utf-8"), at
        except UnicodeDecodeError:
            pass
    return c, end


def atoms(run: str) -> list[str]:
    """A run in atoms. Where it may be read in several ways the longest counts."""
    if not _SHAPED.search(run):
        return list(run)
    out, i = [], 0
    while i < len(run):
        end = max(_next(run, i, m, 3)[1] for m in _UTF8_READ_AS)
        out.append(run[i:end])
        i = end
    return out


def _side(c: str) -> str:
    """What stands beside an atom: an ASCII letter as it is, 0 for figures, a blank for spaces and ends, a dot for others."""
    return c if c.isalpha() else "0" if c.isdigit() else "." if c and not c.isspace() else " "


def units_of(a: str, run: str, b: str) -> list[tuple[str, str, str]]:
    """(before, atom, behind) of each atom of a run between the ASCII characters a and b. X is another atom, U one that is
    of UTF-8 shape as this one is, Z a character of no code page here; those have no sides themselves."""
    parts = atoms(run)
    out = []
    for i, x in enumerate(parts):
        if _REPERTOIRE.isdisjoint(x):
            out.append(("", x, ""))
            continue
        other = lambda y: "U " if len(x) > 1 and len(y) > 1 else "Z " if _REPERTOIRE.isdisjoint(y) else "X "
        out.append((_side(a) if i == 0 else other(parts[i - 1]), x, _side(b) if i == len(parts) - 1 else other(parts[i + 1])))
    return out


def _foreign(c: str) -> bool:
    return c >= "\u0370" and c.isalpha() and not "\u1e00" <= c <= "\u1eff"


def _utf8(run: str, read_as: str) -> tuple[str, int]:
    """run with every valid UTF-8 sequence decoded, and how many there were; other characters stay."""
    table, out, n, i = _TO[read_as], [], 0, 0
    codes = [table.get(c, -1) for c in run]
    while i < len(run):
        b = codes[i]
        k = 2 if 0xC2 <= b <= 0xDF else 3 if 0xE0 <= b <= 0xEF else 4 if 0xF0 <= b <= 0xF4 else 0
        if k and i + k <= len(run) and all(0x80 <= x <= 0xBF for x in codes[i + 1 : i + k]):
            try:
                out.append(bytes(codes[i : i + k]).decode("utf-8"))
                n, i = n + 1, i + k
                continue
            except UnicodeDecodeError:
                pass
        out.append(run[i])
        i += 1
    return "".join(out), n


def candidates(run: str) -> list[tuple[str, str, float]]:
    """(chain, repaired, odds of run as clean text) for every chain that may have made the atom run."""
    if run == LOST:
        return [(GONE, LOST, LOST_IN_CLEAN)]
    found: dict[str, tuple[str, float]] = {}
    c1 = C1_IN_CLEAN ** sum("\x80" <= c <= "\x9f" for c in run)

    def add(chain: str, text: str, odds: float) -> None:
        if text != run:
            found.setdefault(chain, (text, odds))

    for m in _UTF8_READ_AS:
        text, chain = run, f"utf-8 as {m}"
        for depth in range(3):
            text, n = _utf8(text, m if depth == 0 else "cp1252")
            if not n:
                break
            add(chain, text, BY_CHANCE ** (len(run) - len(text)) * c1)
            chain = f"utf-8 as cp1252, utf-8 as {m}" if depth == 0 else f"utf-8 as cp1252 twice, utf-8 as {m}"
    for true, m in _BYTES_READ_AS:
        back, to = _TO[m], _FROM[true]
        add(f"{true} as {m}", "".join(to.get(back.get(c, -1), c) for c in run), c1)
    return [(c, t, o) for c, (t, o) in found.items()]


class Model:
    """What EM learned: for each pool, the garbled units with their chains, repairs and posteriors, and how common the
    chains are; for units that may be garbled, what they would be in a record that is garbled by a chain."""

    def __init__(self, bad: dict[str, dict[tuple[str, str, str], list[tuple[str, str, float]]]], prior: dict[str, dict[str, float]], weak: dict[tuple[str, str, str], dict[str, str]]):
        self.bad, self.prior, self.weak = bad, prior, weak


def fit(counts: list[tuple[str, str, str, str, int]], iterations: int = 10) -> Model:
    """EM over (pool, before, atom, behind, count), the atoms of units_of()."""
    plain = lambda a: "X " if a == "U " else a
    seen: Counter = Counter()
    where: dict[bool, Counter] = {False: Counter(), True: Counter()}  # neighbourhoods, of letters of other scripts apart
    for _, a, run, b, n in counts:
        seen[plain(a), run, plain(b)] += n
        where[_foreign(run[0])][plain(a), plain(b)] += n
    total = sum(seen.values()) or 1
    sums = {f: sum(w.values()) + 1 for f, w in where.items()}
    found = {run: candidates(run) for run in {r for _, _, r, _, _ in counts}}
    open_units = [x for x in counts if found[x[2]]]
    pools = {p for p, *_ in counts}
    names = sorted({c for x in found.values() for c, _, _ in x})
    prior = {p: {CLEAN: 0.98} | {c: 0.02 / max(1, len(names)) for c in names} for p in pools}
    split: dict[str, list[str]] = {}

    def parts(a: str, text: str, b: str) -> list[tuple[str, str, str]]:
        """The units that a repair consists of."""
        if text not in split:
            split[text] = [text] if len(text) == 1 else re.findall(r"[\x00-\x7f]", text) + [x for r in re.findall(r"[^\x00-\x7f]+", text) for x in atoms(r)]
        xs = [x for x in split[text] if not x.isascii()]
        out = []
        for i, x in enumerate(xs):
            free = _REPERTOIRE.isdisjoint(x)
            out.append(("" if free else plain(a) if i == 0 else "X ", x, "" if free else plain(b) if i == len(xs) - 1 else "X "))
        return out

    def by_chance(a: str, b: str, odds: float) -> float:
        return odds * BY_CHANCE ** ((a == "U ") + (b == "U ")) if odds <= BY_CHANCE else odds

    def mixed(a: str, text: str, b: str) -> float:
        return MIXED ** ((_foreign(text[0]) and len(a) == 1 and a.isalpha()) + (_foreign(text[-1]) and len(b) == 1 and b.isalpha()) + (a == "Z ") + (b == "Z "))

    repairs = [[(c, t, by_chance(a, b, o), parts(a, t, b), mixed(a, t, b)) for c, t, o in found[run]] for _, a, run, b, _ in open_units]
    # To begin with, a unit is garbled if a repair of it is far more common than it is, or if chance can't have made it.
    post = []
    for (_, a, run, b, _), rs in zip(open_units, repairs):
        own = seen[plain(a), run, plain(b)]
        w = [max(0.0, min((seen.get(x, 0) for x in xs), default=0) - (5 if o >= 1 else 0.05) * own) for _, _, o, xs, _ in rs]
        if not any(w):
            w = [float(o <= BY_CHANCE**2 and not {a, b} & {"X ", "Z "} and m == 1) for _, _, o, _, m in rs]
        s = sum(w)
        post.append([x / s for x in w] if s else [0.0] * len(w))
    fixed, fixed_run = Counter(), Counter()
    pool_total: Counter = Counter()
    for p, a, run, b, n in counts:
        pool_total[p] += n
        if not found[run]:
            fixed[plain(a), run, plain(b)] += n
            fixed_run[run] += n
    for _ in range(iterations):
        unit, by_run, used = fixed.copy(), fixed_run.copy(), {p: defaultdict(float) for p in pools}
        of_run: dict[str, list[float]] = {}
        given: Counter = Counter()  # what an atom itself gave to a repair is no evidence for that repair
        for (p, a, run, b, n), q, rs in zip(open_units, post, repairs):
            clean = n * (1 - sum(q))
            unit[plain(a), run, plain(b)] += clean
            by_run[run] += clean
            mass = of_run.setdefault(run, [0.0] * (len(q) + 1))
            mass[-1] += clean
            for i, ((c, _, _, xs, _), x) in enumerate(zip(rs, q)):
                if x:
                    for key in xs:
                        unit[key] += n * x
                        given[run, key] += n * x
                        given[run, key[1]] += n * x
                        by_run[key[1]] += n * x
                    used[p][c] += n * x
                    mass[i] += n * x
        for p in pools:
            prior[p] = {c: (used[p][c] + 0.01) / (pool_total[p] + 1) for c in names}
            prior[p][CLEAN] = 1 - min(0.5, sum(prior[p].values()))

        def likelihood(a: str, run: str, b: str, source: str | None = None) -> float:
            f = _foreign(run[0])
            beside = (where[f][a, b] + 1 / 4096) / sums[f]
            here, all_ = unit[a, run, b], by_run[run]
            if source is not None:
                here, all_ = max(0.0, here - given[source, (a, run, b)]), max(0.0, all_ - given[source, run])
            return 0.9 * here / total + (1e-3 * all_ / total + UNSEEN) * beside

        for k, ((p, a, run, b, n), rs) in enumerate(zip(open_units, repairs)):
            mass, odds = of_run[run], min(o for _, _, o, *_ in rs)
            weight = sum(mass) + 2.0
            w = []
            for i, (c, _, o, xs, beside) in enumerate(rs):  # the pool's prior and the atom's own record, over all contexts
                how = 1e-4 if c == GONE else min((likelihood(*x, run) for x in xs), default=UNSEEN) * beside * odds / o
                w.append((mass[i] + 2.0 * prior[p][c]) / weight * how)
            own = likelihood(plain(a), run, plain(b)) * odds
            clean = (mass[-1] + 2.0 * prior[p][CLEAN]) / weight * own
            if run == TYPED:  # typed for a space anywhere, whatever the letters about it
                clean = max(clean, sum(w))
            s = sum(w) + clean
            post[k] = [x / s for x in w] if s > 0 else [0.0] * len(w)
    # In a record garbled by a chain, an atom is taken for garbled by it in nine of ten cases before its context is looked
    # at, one of UTF-8 shape in 999 of 1,000.
    weak: dict[tuple[str, str, str], dict[str, str]] = {}
    for (_, a, run, b, _), rs in zip(open_units, repairs):
        odds = min(o for _, _, o, *_ in rs)
        own = likelihood(plain(a), run, plain(b)) * odds
        likely = {c: t for c, t, o, xs, beside in rs if c != GONE and (9 if o == 1 else 999) * min((likelihood(*x, run) for x in xs), default=UNSEEN) * beside * odds / o > own}
        if likely:
            weak[a, run, b] = likely
    bad: dict[str, dict] = {p: {} for p in pools}
    for (p, a, run, b, _), q, rs in zip(open_units, post, repairs):
        if sum(q) > 0.5 + 1e-9:
            bad[p][a, run, b] = sorted(((c, t, x) for (c, t, *_), x in zip(rs, q) if x > 1e-3), key=lambda z: (-z[2], z[0]))
    return Model(bad, prior, weak)


def _count_units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[str, Counter] = defaultdict(Counter)
    held: dict[str, Counter] = defaultdict(Counter)

    def settle() -> None:
        for pool, runs in held.items():
            to = counts[pool]
            for (a, run, b), n in runs.items():
                for u in units_of(a, run, b):
                    to[u] += n
        held.clear()

    for batch in batches:
        for pool, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if text is not None and not text.isascii():
                held[pool].update(_UNITS.findall(text))
        if sum(map(len, held.values())) > HELD:
            settle()
    settle()
    rows = [(p, *u, n) for p, c in counts.items() for u, n in c.items()]
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*rows)], names=["pool", "a", "atom", "b", "n"])


def _pool(src: str | None, fld: str | None) -> str:
    """As concat_ws has it."""
    return ".".join(x for x in (src, fld) if x is not None)


def learn(values: DataFrame) -> Model:
    """Fit on every row of values (src, fld, ord, text)."""
    pool = F.concat_ws(".", "src", "fld")
    units = values.select(pool.alias("pool"), "text").mapInArrow(_count_units, "pool string, a string, atom string, b string, n long")
    table = units.groupBy("pool", "a", "atom", "b").agg(F.sum("n").alias("n")).toArrow().to_pydict()
    return fit(sorted(zip(*(table[c] for c in ("pool", "a", "atom", "b", "n")))))


RESULT = "src string, fld string, ord long, chain string, posterior double, units long, restored boolean, text string"


class _Judge:
    """Finds and repairs the garbled texts of a pool; runs are looked into once each."""

    def __init__(self, bad: dict, weak: dict):
        self.bad, self.weak = bad, weak
        self.fine, self.hits = set(), {}

    def signs(self, text: str) -> list[tuple[str, str, str]]:
        """The garbled units of a text."""
        found = set(_UNITS.findall(text))
        if found <= self.fine:
            return []
        out = []
        for u in found - self.fine:
            if u not in self.hits:
                hit = [x for x in units_of(*u) if x in self.bad]
                if not hit:
                    self.fine.add(u)
                    continue
                self.hits[u] = hit
            out += self.hits[u]
        if len(self.fine) > 5 * HELD:
            self.fine.clear()
        if len(self.hits) > HELD:
            self.hits.clear()
        return out

    def repair(self, text: str) -> tuple[str, str, float, int, bool] | None:
        """(text, chain, posterior, units, wholly restored) of a garbled text, None for a clean one."""
        if not self.signs(text):
            return None
        votes: Counter = Counter()
        every = [x for u in _UNITS.findall(text) for x in units_of(*u)]
        hit = [x for x in every if x in self.bad]
        for u in hit:
            for c, _, x in self.bad[u]:
                votes[c] += math.log(x + 1e-3) - math.log(1e-3)
        lost = votes.pop(GONE, 0) > 0
        chain = max(votes, key=lambda c: (votes[c], c)) if votes else GONE
        worst = max(min(1.0, sum(x for *_, x in self.bad[u])) for u in hit)

        def fix(u: tuple[str, str, str]) -> str:
            likely = self.weak.get(u, {})
            if u in self.bad:
                return next((t for c, t, _ in self.bad[u] if c == chain), None) or likely.get(chain) or self.bad[u][0][1]
            return likely.get(chain, u[1])

        change = lambda m: m[1] + "".join(map(fix, units_of(m[1], m[2], m[3])))
        return _UNITS.sub(change, text), chain, worst, len(hit), not lost


def _find(model: Model, with_text: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judges: dict[str, _Judge] = {}
        for batch in batches:
            rows = []
            for src, fld, ord_, text in zip(*(c.to_pylist() for c in batch.columns)):
                if text is None or text.isascii():
                    continue
                pool = _pool(src, fld)
                judge = judges.get(pool) or judges.setdefault(pool, _Judge(model.bad.get(pool, {}), model.weak))
                got = judge.repair(text)
                if got:
                    rows.append((src, fld, ord_, got[1], got[2], got[3], got[4], got[0] if with_text else None))
            if rows:
                types = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.float64(), pa.int64(), pa.bool_(), pa.string()]
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), types)], names=[c.split()[0] for c in RESULT.split(", ")])

    return run


def find_garbled(values: DataFrame, model: Model | None = None, with_text: bool = True) -> DataFrame:
    """Garbled values among values (src, fld, ord, text): the record's chain, the highest posterior of a unit, the number
    of garbled units, whether all could be restored, and the repaired text."""
    model = model or learn(values)
    return values.select("src", "fld", F.col("ord").cast("long").alias("ord"), "text").mapInArrow(_find(model, with_text), RESULT)


def without_garbled(values: DataFrame, model: Model, *keep: str) -> DataFrame:
    """The rows of values (src, fld, text and more) that aren't garbled; only the columns of keep come out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judges = {pool: _Judge(bad, model.weak) for pool, bad in model.bad.items()}
        none = _Judge({}, {})
        for b in batches:
            names = b.schema.names
            src, fld, text = (b.column(names.index(c)).to_pylist() for c in ("src", "fld", "text"))
            ok = [t is None or t.isascii() or not judges.get(_pool(s, f), none).signs(t) for s, f, t in zip(src, fld, text)]
            yield b.select(list(keep)).filter(pa.array(ok, pa.bool_()))

    out = values.select(*dict.fromkeys((*keep, "src", "fld", "text")))
    return out.mapInArrow(run, out.select(*keep).schema)
