"""Secrets by pattern, and by format grammars inferred from the secrets that patterns found.

Grammar inference: the found credentials of a kind build a prefix tree with
counts, over classes of characters, but over a character itself where so many
samples share it that it belongs to the format.  States whose outgoing
frequencies do not differ by more than chance allows (Hoeffding bounds, checked
down the tree) are merged.  What remains is a probabilistic automaton with the
lengths that end in it.  Another one is inferred from ordinary words.  A
candidate is a secret if some credential automaton has a path for it, and it is
much likelier there, length included, than among ordinary words.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from ledgerline.llm.common import map_batches, texts, written

# The patterns of the three base kinds, in the order in which kinds are listed.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
KINDS = ("assign", "access", "hex", "learned")
LEAST = {"assign": 6, "access": 20, "hex": 24}

#: Signs of a candidate at least, as many as the shortest credential that trains a grammar, and the shape of one.
SHORT = 6
RUN = re.compile(r"[A-Za-z0-9+/_=-]{6,}")
#: Pieces between white space that can hold a hex span.
LONG = 24
#: Log odds against a candidate being a secret: one in ten thousand.
MARGIN = 9.2
WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")


def base_spans(text: str) -> list[tuple[str, int, int, str]]:
    """(kind, start, end, secret) of the base kinds, by start and then kind."""
    out = []
    lower = text.lower()
    if any(w in lower for w in WORDS):
        out += [("assign", *m.span(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]]
    if "AKIA" in text:
        out += [("access", *m.span(), m[0]) for m in ACCESS.finditer(text) if len(m[0]) >= LEAST["access"]]
    for at, word in long_words(text):
        out += [("hex", at + m.start(), at + m.end(), m[0]) for m in HEX.finditer(word) if len(m[0]) >= LEAST["hex"]]
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


def long_words(text: str) -> Iterator[tuple[int, str]]:
    """Pieces between white space of at least `LONG` characters, with their places."""
    at = 0
    for word in text.split():
        if len(word) >= LONG:
            at = text.index(word, at)
            yield at, word
            at += len(word)


def candidates(text: str, base: list[tuple[str, int, int, str]]) -> Iterator[tuple[int, int, str]]:
    """Runs of letters, digits and the signs of base64, and what base spans leave of them."""
    if base:
        # Blanks in the place of base spans: one pass, however many spans a long text has.
        pieces, done = [], 0
        for start, end in sorted((a, b) for _, a, b, _ in base):
            pieces += [text[done:start], " " * (end - max(start, done))]
            done = max(done, end)
        text = "".join((*pieces, text[done:]))
    for m in RUN.finditer(text):
        yield *m.span(), m[0]


# Classes of characters with the number of their members; any other character is a class of its own.
CLASSES = {"0": "0123456789", "a": "abcdef", "g": "ghijklmnopqrstuvwxyz", "A": "ABCDEF", "G": "GHIJKLMNOPQRSTUVWXYZ"}
CLASS = {c: f"[{name}]" for name, members in CLASSES.items() for c in members}
SIZE = {f"[{name}]": len(members) for name, members in CLASSES.items()}


def literals(chars: Iterable[str]) -> set[str]:
    """Characters that stand out of their class: at least eight, and four times as many as if all of it were alike."""
    count = Counter(chars)
    classes: Counter = Counter()
    for c, n in count.items():
        classes[CLASS.get(c, c)] += n
    return {c for c, n in count.items() if c in CLASS and n >= 8 and n * SIZE[CLASS[c]] > 4 * classes[CLASS[c]]}


def kinds_of(text: str) -> tuple[bool, bool, bool]:
    """Has it small letters, capitals, digits?"""
    return text != text.upper(), text != text.lower(), any(map(str.isdigit, text))


class Automaton:
    """A probabilistic deterministic automaton over character classes and literals, inferred by state merging."""

    def __init__(self, samples: Iterable[str], alpha: float = 0.05):
        self.next: list[dict[str, int]] = [{}]
        self.seen: list[dict[str, int]] = [{}]
        self.ends: list[int] = [0]
        self.bound = math.sqrt(0.5 * math.log(2 / alpha))
        samples = list(samples)
        self.lengths, self.mixes = Counter(map(len, samples)), {kinds_of(x) for x in samples}
        todo = [(0, 0, samples)]
        while todo:
            state, depth, here = todo.pop()
            longer = [x for x in here if len(x) > depth]
            self.ends[state] = len(here) - len(longer)
            own, below = literals(x[depth] for x in longer), defaultdict(list)
            for x in longer:
                c = x[depth]
                below[c if c in own else CLASS.get(c, c)].append(x)
            for symbol, those in below.items():
                self.seen[state][symbol] = len(those)
                self.next[state][symbol] = len(self.next)
                todo.append((len(self.next), depth + 1, those))
                self.next.append({})
                self.seen.append({})
                self.ends.append(0)
        self._merge()
        self._weigh()

    def _total(self, state: int) -> int:
        return self.ends[state] + sum(self.seen[state].values())

    def _alike(self, a: int, b: int) -> float | None:
        """Log-likelihood of what is below b if it began at a, or none if both can't come from one distribution."""
        todo, total = [(a, b)], 0.0
        while todo:
            a, b = todo.pop()
            n, m = self._total(a), self._total(b)
            if not m:
                continue
            most = self.bound * (1 / math.sqrt(max(n, 1)) + 1 / math.sqrt(m))
            if n and abs(self.ends[a] / n - self.ends[b] / m) > most:
                return None
            for c in self.seen[a].keys() | self.seen[b].keys():
                k, here = self.seen[a].get(c, 0), self.seen[b].get(c, 0)
                if n and abs(k / n - here / m) > most:
                    return None
                total += here * math.log((k + 0.05) / (n + 1))
                if c in self.next[a] and c in self.next[b]:
                    todo.append((self.next[a][c], self.next[b][c]))
        return total

    def _fold(self, a: int, b: int) -> None:
        """Add the tree below b to the automaton at a."""
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            self.ends[a] += self.ends[b]
            for c, n in self.seen[b].items():
                self.seen[a][c] = self.seen[a].get(c, 0) + n
                if c in self.next[a]:
                    todo.append((self.next[a][c], self.next[b][c]))
                else:
                    self.next[a][c] = self.next[b][c]

    def _merge(self) -> None:
        """Of the states next to settled ones that of most samples joins the settled one that suits it best, or settles."""
        settled = [0]
        while True:
            known = set(settled)
            fringe = [(-self._total(x), s, c) for s in settled for c, x in self.next[s].items() if x not in known]
            if not fringe:
                break
            _, state, c = min(fringe)
            child = self.next[state][c]
            suits = [(found, -k, old) for k, old in enumerate(settled) if (found := self._alike(old, child)) is not None]
            if suits:
                old = max(suits)[2]
                self.next[state][c] = old
                self._fold(old, child)
            else:
                settled.append(child)
        place = {s: k for k, s in enumerate(settled)}
        self.next = [{c: place[x] for c, x in self.next[s].items()} for s in settled]
        self.seen = [self.seen[s] for s in settled]
        self.ends = [self.ends[s] for s in settled]

    def _weigh(self) -> None:
        self.weights = []
        for seen in self.seen:
            total = sum(seen.values()) + 1
            self.weights.append({c: math.log(n / total / SIZE.get(c, 1)) for c, n in seen.items()})
        # What a state never saw comes once in all it saw, and is then spread as all signs of the samples are.
        usual: Counter = Counter()
        for seen in self.seen:
            for c, n in seen.items():
                usual[CLASS.get(c, c)] += n
        everything = sum(usual.values()) + 96
        self.usual = {c: math.log((n + 1) / everything / SIZE.get(c, 1)) for c, n in usual.items()}
        self.unusual = math.log(1 / everything)
        self.escape = [-math.log(sum(seen.values()) + 1) for seen in self.seen]
        total = sum(self.lengths.values()) + 1
        self.long = {n: math.log(k / total) for n, k in self.lengths.items()}
        self.unheard = math.log(0.1 / total)

    def likelihood(self, text: str, strict: bool = False) -> float:
        """Log-likelihood of the signs of a text and of its length.

        If `strict`, what a state never saw is impossible, and so are kinds of
        signs (digits alone, say) that no sample had together.  Else it counts as
        rare, and the automaton begins anew there, as compound words do; and the
        text is at least as likely as signs drawn from all of the samples.
        """
        state, total, long = 0, 0.0, self.long.get(len(text), self.unheard)
        for c in text:
            weights = self.weights[state]
            if c not in weights:
                c = CLASS.get(c, c)
                if c not in weights:
                    if strict:
                        return -math.inf
                    total += self.escape[state] + self.usual.get(c, self.unusual)
                    state = self.next[0].get(c, 0)
                    continue
            total += weights[c]
            state = self.next[state][c]
        if strict:
            return long + total if kinds_of(text) in self.mixes else -math.inf
        return long + max(total, sum(self.usual.get(CLASS.get(c, c), self.unusual) for c in text))


SPAN = pa.list_(
    pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("secret", pa.string())])
)
EXAMPLES = pa.schema([("kind", pa.string()), ("secret", pa.string())])


def ordinary(text: str, base: list[tuple[str, int, int, str]], words: int) -> list[str]:
    """The first `words` distinct candidates of a text, by hash, so that one text cannot give them all."""
    found = {zlib.crc32(w.encode()): w for w in {w for _, _, w in candidates(text, base)}}
    return [found[h] for h in sorted(found)[:words]]


def learn(docs: DataFrame, sample: int, margin: float, words: int) -> Grammars:
    """Grammars from the credentials and ordinary words of all texts; only these examples are written."""

    def examples(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        rows = set()
        for text in texts(batch):
            base = base_spans(text)
            rows.update((kind, secret) for kind, _, _, secret in base)
            rows.update(("plain", word) for word in ordinary(text, base, words))
        columns = list(zip(*sorted(rows))) or ((), ())
        yield pa.record_batch([pa.array(c, pa.string()) for c in columns], schema=EXAMPLES)

    return Grammars(written(map_batches(docs.select("text"), examples, EXAMPLES), "examples"), sample, margin)


#: Signs of a training example at most: this and their number bound what the driver holds. Candidates have any length.
LONGEST = 256
#: Candidates whose verdict a worker remembers.
REMEMBERED = 300_000


class Grammars:
    """One automaton for each kind of which (kind, secret) rows have examples, and that of ordinary words."""

    def __init__(self, labelled: DataFrame, sample: int, margin: float):
        found, labelled = {}, labelled.filter(F.length("secret") <= LONGEST)
        for kind in ("assign", "access", "hex", "plain"):
            drawn = labelled.filter(F.col("kind") == kind).select("secret").distinct()
            values = [r["secret"] for r in drawn.orderBy(F.xxhash64("secret"), "secret").limit(sample).collect()]
            if values:
                found[kind] = Automaton(values)
        self.plain, self.margin = found.pop("plain", None) or Automaton([]), margin
        self.kinds, self.known = found, {}

    def accept(self, word: str) -> bool:
        verdict = self.known.get(word)
        if verdict is None:
            likely = max((g.likelihood(word, strict=True) for g in self.kinds.values()), default=-math.inf)
            verdict = likely > -math.inf and likely >= self.plain.likelihood(word) + self.margin
            if len(self.known) >= REMEMBERED:
                self.known.clear()
            if len(word) <= LONGEST:
                self.known[word] = verdict
        return verdict

    def spans(self, text: str, base: list[tuple[str, int, int, str]]) -> list[tuple[str, int, int, str]]:
        """Candidates beside the base spans that are secrets by their format."""
        if not self.kinds:
            return []
        return [("learned", a, b, word) for a, b, word in candidates(text, base) if self.accept(word)]


def find_secrets(docs: DataFrame, sample: int = 400, margin: float = MARGIN, words: int = 2) -> DataFrame:
    """All columns of `docs` but the text, with `base` and `learned`: arrays of (kind, start, end, secret).

    Places are code points of the whole text, ends exclusive.  A NULL text has
    none.  Rows that repeat are searched each; columns of `docs` with these names
    give way.  Grammars are inferred from at most `sample` distinct secrets of
    each kind, of `LONGEST` signs or less, and as many ordinary words, of which a
    text offers `words`: those of the smallest hash.  A kind that was never found
    infers no grammar, and without ordinary words an empty one stands for them.
    What a base span covers is that span; of the rest each run of six signs or
    more is `learned` if a grammar has a path for all its signs and an example
    with the same kinds of signs, and its log-likelihood is above that of
    ordinary words by `margin`.

    Texts are scanned twice: for the examples, which alone are written, and to
    find what the patterns and the grammars know.
    """
    docs = docs.drop("base", "learned")
    others = [c for c in docs.columns if c != "text"]
    grammars = learn(docs, sample, margin, words)
    schema = pa.schema([*to_arrow_schema(docs.select(*others).schema), ("base", SPAN), ("learned", SPAN)])
    fields = ("kind", "start", "end", "secret")

    def scan(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        base = [base_spans(text) for text in texts(batch)]
        learned = [grammars.spans(text, b) for text, b in zip(texts(batch), base)]
        spans = [pa.array([[dict(zip(fields, s)) for s in row] for row in side], SPAN) for side in (base, learned)]
        yield pa.record_batch([*(batch.column(batch.schema.get_field_index(c)) for c in others), *spans], names=schema.names)

    return map_batches(docs, scan, schema)


def span_list(spans: Column) -> Column:
    """kind:start:end of every span, by start and then kind as listed, joined by commas."""
    kinds = F.array(*map(F.lit, KINDS))
    ranked = F.array_sort(
        F.transform(
            spans,
            lambda s: F.struct(
                s["start"].alias("start"),
                F.array_position(kinds, s["kind"]).alias("rank"),
                s["end"].alias("end"),
                s["kind"].alias("kind"),
            ),
        )
    )
    return F.array_join(F.transform(ranked, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redact(docs: DataFrame, mark: str = "[SECRET]", sample: int = 400, margin: float = MARGIN, words: int = 2) -> DataFrame:
    """`docs` with every found span of its texts replaced by `mark`, and `n_chars`, if there, brought in line.

    A span that begins inside the one before it is covered by the same mark.  A
    NULL text stays NULL, and rows without secrets stay as they are.  An `n_chars`
    that is no whole number stays too.

    Texts are scanned twice: for the examples of the grammars, which alone are
    written, and to blank what the patterns and the grammars find in place.
    """
    grammars = learn(docs, sample, margin, words)
    out, names = to_arrow_schema(docs.schema), docs.columns
    counted = "n_chars" in names and pa.types.is_integer(out.field("n_chars").type)

    def blanked(text: str) -> str:
        base = base_spans(text)
        learned = grammars.spans(text, base)
        if not (base or learned):
            return text
        pieces, done = [], 0
        for start, end in sorted((a, b) for _, a, b, _ in (*base, *learned)):
            if start >= done:
                pieces += [text[done:start], mark]
            done = max(done, end)
        return "".join((*pieces, text[done:]))

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        before = batch.column(names.index("text")).to_pylist()
        after = [text and blanked(text) for text in before]
        columns = list(batch.columns)
        columns[names.index("text")] = pa.array(after, out.field("text").type)
        if counted:
            k = names.index("n_chars")
            sizes = [n if a == b else len(b) for n, a, b in zip(columns[k].to_pylist(), before, after)]
            columns[k] = pa.array(sizes, out.field("n_chars").type)
        yield pa.record_batch(columns, names=names)

    return map_batches(docs, work, out)
