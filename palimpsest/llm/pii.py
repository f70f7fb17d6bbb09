"""Personal data by rules and a skip-chain conditional random field.

Rules find e-mail addresses, IP addresses, card and phone numbers. Tokens that hold a digit or an
at-sign are the nodes of a random field per document: neighbouring nodes share chain potentials,
and distant nodes with the same digits or mailbox share skip potentials. Loopy message passing
carries what the rules are sure of to repeated and similar tokens that no rule matches. All nodes
of a key are linked to one that a rule labels, so distance and number of repeats do not matter.
Secrets (access tokens, keys) have no rule of their own: the field alone labels them. Its potentials
for them are learned from long mixed strings that the text assigns to a name in quotes, against a prior
of such strings that are none; they weigh how a string is assigned, the words before it, and whether it is
made of words. A string that says nothing for itself is labelled where it repeats one that does, or its
beginning; hashes, paths, slugs and identifiers are left alone.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_slices, tidy

KINDS = ("email", "ip", "card", "phone")
#: What the field labels: the rules' kinds, and secrets.
LABELS = (*KINDS, "secret")
#: Log-odds against a token that every rule rejects; only evidence from other tokens outweighs it.
REJECTED = 4.0
#: Message passing ends, per document, when no message moves by more than SETTLED, or after ROUNDS.
ROUNDS = 200
SETTLED = 1e-7
#: Log-odds against other labels than the rule's; more than any number of repeats can send.
FIXED = -1e9

_LOCAL, _DOMAIN = re.compile(r"[A-Za-z0-9._%+-]+\Z"), re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# a run of digits is tried from its first digit only: from a later one it would fail alike
_IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++){3}")
_CARD = re.compile(r"[0-9]([ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_ANY, _DIGIT = re.compile(r"[0-9@+]"), re.compile(r"[0-9]")
_TOKEN = re.compile(r"[^\x20\x09-\x0D]+")
#: A string that may be a secret: long, of letters and digits; after a name and a sign of its own token, if there is one.
_MIXED = re.compile(r"(?=[^0-9]*[0-9])(?=[^A-Za-z]*[A-Za-z])[A-Za-z0-9+/_=-]{20,}")
_NAMED = re.compile(r"[A-Za-z_][A-Za-z0-9_.-]*[=:][\"']?")
#: Parts of a slug, path or name: words, and numbers that stand apart from them.
_PART = re.compile(r"[A-Za-z]+|[0-9]+")
_MARKS = ".,;:!?()[]\"'<>`#*"
#: A group of digits, without closing marks, as part of a number written in several tokens.
_GROUP = re.compile(r"[(\[<\"']*(\+?)[(]?[0-9][0-9().-]*\Z")


def luhn(digits: str) -> bool:
    """Whether the last digit is the check digit of the others."""
    values = [int(d) for d in reversed(digits)]
    return (sum(values[0::2]) + sum(sum(divmod(2 * v, 10)) for v in values[1::2])) % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Each at-sign in turn, with the mailbox characters before it back to the last match."""
    end = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            yield start, m.end()
            end = m.end()
        at = text.find("@", max(at + 1, end))


def base_spans(text: str | None) -> list[tuple[int, int, int]]:
    """(start, end, index of kind) of what the rules find, in order; leftmost and apart per kind."""
    text = text or ""
    found = [(a, b, 0) for a, b in _emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        if "." in text:
            found += [(*m.span(), 1) for m in _IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in m[0].split("."))]
        for m in _CARD.finditer(text):
            digits = re.sub("[ -]", "", m[0])
            if 14 <= len(digits) <= 19 and luhn(digits):
                found.append((*m.span(), 2))
        if "+" in text:
            found += [(*m.span(), 3) for m in _PHONE.finditer(text) if 10 <= len(_DIGIT.findall(m[0])) <= 15]
    return sorted(found, key=lambda s: (s[0], s[2]))


def mixed_string(token: str) -> tuple[int, int] | None:
    """Place of a string that may be a secret in a token, without marks and the name that it is assigned to."""
    if len(token) < 20:
        return None
    start = len(token) - len(token.lstrip(_MARKS))
    if m := _NAMED.match(token, start):
        start = m.end()
    end = len(token.rstrip(_MARKS))
    return (start, end) if start < end and _MIXED.fullmatch(token, start, end) else None


def wordy(core: str) -> bool:
    """Whether a string is made of words and numbers side by side, as slugs, paths and names are: with marks between,
    few changes between letters and digits for its length, and words of one case."""
    if not any(c in core for c in "-_/"):
        return False
    parts = _PART.findall(core)
    words = [w for w in parts if len(w) >= 3 and w.isalpha() and (w[1:].islower() or w.isupper())]
    return len(parts) <= len(core) / 4 and 2 * sum(map(len, words)) > sum(map(len, parts))


#: Words before a string, or in the name that it is assigned to, that speak for a secret, and against one.
_SAYS = re.compile(r"(?:^|[^a-z])(?:\w*_)?(?:key|token|secret|password|passwd|passphrase|pwd|auth|credentials?|bearer)s?\W*\Z", re.I)
_DENIES = re.compile(r"(?:^|[^a-z])(?:commit|sha\d*|md5|hash|rev|revision|checksum|digest|etag|uuid|guid|doi|isbn|urn|url|https?|file|path|version|branch|title|slug|name|id)\W*\Z", re.I)


def node_features(token: str, before: str = "") -> list[int]:
    """Indicators of a token's form, and of the text before it on its line."""
    lead = before.rstrip(" \t")[-1:]
    at = mixed_string(token)
    mixed, quoted = at is not None, at is not None and token[at[0] - 1 : at[0]] in ("'", '"')
    named = mixed and (lead in ("=", ":") or token[: at[0]].rstrip("'\"")[-1:] in ("=", ":"))
    digits = sum(c.isdigit() for c in token)
    core = token.strip(".,;:!?()[]\"'")
    return [
        1, "@" in core, "." in core.partition("@")[2], core.count(".") == 3 and "@" not in core, core.startswith("+"), "-" in core,
        digits == 0, 1 <= digits <= 2, digits == 3, 4 <= digits <= 6, digits == 7, 8 <= digits <= 13, 14 <= digits <= 19, digits > 19,
        digits > 0 and core.isdigit(), token.startswith("("), 14 <= digits <= 19 and core.isdigit() and core.isascii() and luhn(core),
        any(c.isalpha() for c in core), mixed, named and quoted, named and not quoted, mixed and not named, mixed and wordy(token[slice(*at)]),
        mixed and _SAYS.search(before + token[: at[0]]) is not None, mixed and _DENIES.search(before + token[: at[0]]) is not None,
    ]


def assigned_secret(token: str, before: str) -> bool:
    """Whether a token is taken as a secret when potentials are learned: a mixed string in quotes, assigned to a name."""
    f = node_features(token, before) if len(token) >= 20 else None
    return f is not None and bool(f[QUOTED]) and not f[WORDY] and not f[DENIES]


def skip_key(token: str) -> str | None:
    """What makes distant tokens alike: the last seven of five digits or more, the mailbox, or the first 16 letters of a mixed string."""
    if (at := mixed_string(token)) is not None:
        return token[at[0] : at[0] + 16]
    mailbox, at, _ = token.strip(".,;:!?()[]\"'<>").partition("@")
    if at and mailbox:
        return mailbox.lower()
    digits = "".join(c for c in token if c in "0123456789")
    return digits[-7:] if len(digits) >= 5 else None


@dataclass
class Graph:
    """The nodes and edges of some documents: nodes have a document, span, and rule label (0: none)."""

    doc: np.ndarray
    start: np.ndarray
    end: np.ndarray
    label: np.ndarray
    features: np.ndarray
    chain: np.ndarray
    skip: np.ndarray
    #: Pairs of nodes of one key in successive occurrences, whatever their labels; for statistics.
    repeats: np.ndarray | None = None
    #: The labels that potentials are learned from: the rules', and assigned secrets.
    learned: np.ndarray | None = None


def _occurrences(tokens: list[tuple[int, int, str]]) -> Iterator[tuple[str, list[int], list[str]]]:
    """(key, nodes, their digits) of each occurrence of a number or mailbox, the last node at its end.

    ``tokens`` are (node, place, token). A token of five digits or a mailbox is an occurrence by
    itself; a number in groups is one under its joined digits. Groups before belong to either.
    """
    run: list[tuple[int, str]] = []
    last, open_ = -2, False
    for at, (node, place, token) in enumerate(tokens):
        core = token.rstrip(".,;:!?]>\"'")
        group = _GROUP.match(core)
        if not (group and open_ and place == last + 1) or group[1]:
            run = []
        digits = "".join(c for c in token if c in "0123456789")
        if group:
            run.append((node, digits))
            del run[:-20]
        last, open_ = place, bool(group) and core == token
        follows = open_ and at + 1 < len(tokens) and tokens[at + 1][1] == place + 1 and (m := _GROUP.match(tokens[at + 1][2])) and not m[1]
        own = skip_key(token)
        members = run if group else [(node, digits)]
        if own is not None:
            yield own, [n for n, _ in members], [d for _, d in members]
        if len(members) > 1 and len(digits) < 7 and not follows:
            joined = "".join(d for _, d in members)[-7:]
            if len(joined) >= 5 and joined != own:
                yield joined, [n for n, _ in members], [d for _, d in members]


def _alike(nodes: list[int], digits: list[str], other: list[str]) -> list[int]:
    """The last node, and those before it whose digits both occurrences end with."""
    own, whole = "".join(digits), "".join(other)
    shared = 0
    while shared < min(len(own), len(whole)) and own[-1 - shared] == whole[-1 - shared]:
        shared += 1
    out, left = nodes[-1:], shared - len(digits[-1])
    for n, d in zip(nodes[-2::-1], digits[-2::-1]):
        left -= len(d)
        if left < 0:
            break
        out.append(n)
    return out


def _key_edges(tokens: list[tuple[int, int, str]], label: list[int]) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
    """Skip edges and pairs for statistics within a document.

    The nodes of a key that no rule labels are linked to one node of each label that the key has
    (its longest number), so that what a rule found reaches every repeat in one step and is not
    outvoted by the repeats; without any label, to the key's first. Edges are linear in the tokens.
    """
    keys: dict[str, list[tuple[list[int], list[str]]]] = {}
    for key, nodes, digits in _occurrences(tokens):
        keys.setdefault(key, []).append((nodes, digits))
    skip: set[tuple[int, int]] = set()
    repeats = []
    for found in keys.values():
        for (before, digits), (nodes, own) in zip(found, found[1:]):
            repeats += [(before[-1], n) for n in _alike(nodes, own, digits)]
        hubs: dict[int, tuple[list[int], list[str]]] = {}
        for nodes, digits in found:
            kind = label[nodes[-1]]
            if kind and (kind not in hubs or sum(map(len, digits)) > sum(map(len, hubs[kind][1]))):
                hubs[kind] = (nodes, digits)
        for hub, whole in hubs.values() or found[:1]:
            for nodes, digits in found:
                skip.update((hub[-1], n) for n in _alike(nodes, digits, whole) if not label[n] and n not in hub)
    return sorted(skip), repeats


def build_graph(texts: list[str | None], spans: list[list[tuple[int, int, int]]]) -> Graph:
    """Edges join a node to the next token's node, and to a node of the same key (see _key_edges):
    their number is linear in that of the nodes, however often a token repeats."""
    doc, start, end, label, features, chain, skip, repeats, learned = [], [], [], [], [], [], [], [], []
    for d, (text, known) in enumerate(zip(texts, spans)):
        if not text or not _ANY.search(text):
            continue
        tokens: list[tuple[int, int, str]] = []
        k, before = 0, -2
        for i, m in enumerate(_TOKEN.finditer(text)):
            token = m[0]
            if not _ANY.search(token):
                continue
            a, b = m.span()
            while k < len(known) and known[k][1] <= a:
                k += 1
            over = [s[2] + 1 for s in known[k : k + 4] if s[0] < b and s[1] > a]
            node = len(doc)
            context = text[max(a - 40, 0) : a].rpartition("\n")[2] if len(token) >= 20 else ""
            doc.append(d), start.append(a), end.append(b), label.append(over[0] if over else 0), features.append(node_features(token, context))
            learned.append(label[-1] or (N_LABELS - 1 if assigned_secret(token, context) else 0))
            if before == i - 1:
                chain.append((node - 1, node))
            before = i
            tokens.append((node, i, token))
        edges, pairs_of_keys = _key_edges(tokens, label)
        skip += edges
        repeats += pairs_of_keys
    pairs = lambda e: np.array(e, np.int64).reshape(-1, 2)
    return Graph(np.array(doc, np.int64), np.array(start, np.int64), np.array(end, np.int64), np.array(label, np.int64),
                 np.array(features, np.float64).reshape(len(doc), N_FEATURES), pairs(chain), pairs(skip), pairs(repeats),
                 np.array(learned, np.int64))


@dataclass
class Field:
    """Log potentials: unary (features x labels), chain and skip (labels x labels)."""

    unary: np.ndarray
    chain: np.ndarray
    skip: np.ndarray


N_LABELS = len(LABELS) + 1
N_FEATURES = len(node_features(""))
#: Features of strings that may be secrets: all; assigned in quotes; assigned without; not assigned; of words; under a word that speaks for or against.
MIXED, QUOTED, UNQUOTED, LOOSE, WORDY, SAYS, DENIES = range(N_FEATURES - 7, N_FEATURES)
#: Such strings (that are none, that are secrets) which learning begins from, as a corpus may show secrets alone, or none.
PRIOR = {MIXED: (2_000.0, 200.0), QUOTED: (4.0, 100.0), UNQUOTED: (40.0, 40.0), LOOSE: (2_000.0, 0.0), WORDY: (20_000.0, 0.0), SAYS: (2.0, 200.0), DENIES: (20_000.0, 0.0)}


def statistics(graph: Graph) -> np.ndarray:
    """Counts that potentials are estimated from: labels by feature, by chain edge, by pair of repeats."""
    hot = np.eye(N_LABELS)[graph.learned]
    unary = graph.features.T @ hot
    edges = [np.bincount(graph.learned[e[:, 0]] * N_LABELS + graph.learned[e[:, 1]], minlength=N_LABELS**2) for e in (graph.chain, graph.repeats)]
    return np.concatenate([unary.ravel(), *edges]).astype(float)


def estimate(counts: np.ndarray) -> Field:
    """Piecewise estimates: each feature's and each edge kind's log odds over independence, smoothed.

    Edge potentials lie within +-6; those of skips are symmetric, and begin from 1000 pairs of
    tokens that are neither and 20 of each kind.
    """
    n = N_FEATURES * N_LABELS
    unary = counts[:n].reshape(N_FEATURES, N_LABELS) + 0.5
    for feature, (none, some) in PRIOR.items():
        unary[feature, 0] += none
        unary[feature, -1] += some
    prior = unary[0] / unary[0].sum()
    weight = np.log(unary / unary.sum(1, keepdims=True)) - np.log(prior)
    weight[0] = np.log(prior)
    weight[1:MIXED, -1] = weight[1:MIXED, 0]  # the form of a number says nothing of secrets, whose own features would only count it again

    def edge(c: np.ndarray) -> np.ndarray:
        c = c.reshape(N_LABELS, N_LABELS) + 0.5
        c = c / c.sum()
        return np.clip(np.log(c) - np.log(c.sum(1))[:, None] - np.log(c.sum(0))[None], -6, 6)

    skip = counts[n + N_LABELS**2 :].reshape(N_LABELS, N_LABELS)
    return Field(weight / 3, edge(counts[n : n + N_LABELS**2]), edge(skip + skip.T + np.diag([1000.0] + [20.0] * len(LABELS))))


def marginals(graph: Graph, field: Field, rounds: int = ROUNDS) -> np.ndarray:
    """Label probabilities of each node by damped loopy belief propagation; rule labels are fixed."""
    n = len(graph.doc)
    unary = graph.features @ field.unary
    unary[:, 1 : len(KINDS) + 1] -= REJECTED
    unary[graph.features[:, MIXED] == 0, len(LABELS)] = FIXED  # a secret is a mixed string
    fixed = graph.label > 0
    unary[fixed] = np.where(np.eye(N_LABELS, dtype=bool)[graph.label[fixed]], 0, FIXED)
    edges = np.concatenate([graph.chain, graph.skip])
    tables = np.concatenate([np.repeat(field.chain[None], len(graph.chain), 0), np.repeat(field.skip[None], len(graph.skip), 0)])
    src = np.concatenate([edges[:, 0], edges[:, 1]])
    dst = np.concatenate([edges[:, 1], edges[:, 0]])
    tables = np.concatenate([tables, tables.transpose(0, 2, 1)])
    back = np.concatenate([np.arange(len(edges)) + len(edges), np.arange(len(edges))])
    messages = np.zeros((len(src), N_LABELS))
    live, owner = np.arange(len(src)), graph.doc[src]

    def beliefs() -> np.ndarray:
        total = unary.copy()
        for k in range(N_LABELS):
            total[:, k] += np.bincount(dst, weights=messages[:, k], minlength=n)
        return total

    for _ in range(rounds):
        if not len(live):
            break
        out = (beliefs()[src[live]] - messages[back[live]])[:, :, None] + tables[live]
        top = out.max(1, keepdims=True)
        new = np.log(np.exp(out - top).sum(1)) + top[:, 0]
        new = 0.5 * messages[live] + 0.5 * (new - new.max(1, keepdims=True))
        busy = np.zeros(owner.max() + 1, bool)
        busy[owner[live[np.abs(new - messages[live]).max(1) > SETTLED]]] = True
        messages[live] = new
        live = live[busy[owner[live]]]
    b = beliefs()
    p = np.exp(b - b.max(1, keepdims=True))
    return p / p.sum(1, keepdims=True)


def added_spans(texts: list[str | None], spans: list[list[tuple[int, int, int]]], field: Field) -> list[list[tuple[int, int, int]]]:
    """What the field adds to the rules' spans: nodes that no rule labels, more likely of one kind
    than all else; neighbours of one kind join. Brackets and closing marks stay outside."""
    graph = build_graph(texts, spans)
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    if not len(graph.doc):
        return out
    p = marginals(graph, field)
    best = p.argmax(1)
    chained = set(graph.chain[:, 1].tolist())
    previous = -2
    for i in np.flatnonzero((graph.label == 0) & (best > 0) & (p.max(1) > 0.5)).tolist():
        text, kind = texts[graph.doc[i]], int(best[i]) - 1
        a, b = int(graph.start[i]), int(graph.end[i])
        if kind >= len(KINDS):
            start, end = mixed_string(text[a:b])
            a, b = a + start, a + end
        while b > a and text[b - 1] in ".,;:!?)]>\"'":
            b -= 1
        while a < b and text[a] in "[<\"'":
            a += 1
        if a == b:
            continue
        own = out[graph.doc[i]]
        if previous == i - 1 and i in chained and own and own[-1][2] == kind:
            own[-1] = (own[-1][0], b, kind)
        else:
            own.append((a, b, kind))
        previous = i
    return out


def train(docs: DataFrame, text_col: str = "text") -> Field:
    """Estimate potentials from the rules' labels in all documents.

    Tasks add up counts; a fixed number of sums reaches the driver. Null texts are allowed, and an
    empty table gives the potentials of smoothing alone.
    """
    size = len(statistics(build_graph([], [])))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(size)
        for batch in batches:
            for part in text_slices(batch, "text"):
                texts = part.column("text").to_pylist()
                counts += statistics(build_graph(texts, [base_spans(t) for t in texts]))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size, dtype=np.int32)), pa.array(counts)], ["at", "n"])

    counts = np.zeros(size)
    for row in docs.select(F.col(text_col).alias("text")).mapInArrow(tidy(run), "at int, n double").groupBy("at").agg(F.sum("n").alias("n")).collect():
        counts[row.at] = row.n
    return estimate(counts)


SPANS = "array<struct<kind:string,start:int,end:int,base:boolean>>"
_SPANS_ARROW = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_())]))


def find(docs: DataFrame, field: Field, text_col: str = "text", redacted: bool = False) -> DataFrame:
    """All rows of ``docs`` with ``pii`` added: spans (kind, start, end in code points, base) by start, then kind.

    Null and empty texts have none. Texts are taken whole; an input column ``pii`` is replaced. With
    ``redacted`` the text itself has each run of overlapping spans replaced by its first kind in
    angle brackets, and a null text stays null.
    """
    rest = docs.drop("pii")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rest.schema.fields) + f", pii {SPANS}"
    at = rest.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, text_col):
                texts = part.column(at).to_pylist()
                base = [base_spans(t) for t in texts]
                more = added_spans(texts, base, field)
                every = [sorted([(*s, True) for s in b] + [(*s, False) for s in m], key=lambda s: (s[0], s[2], s[1])) for b, m in zip(base, more)]
                columns = list(part.columns)
                if redacted:
                    columns[at] = pa.array([t and redact(t, s) for t, s in zip(texts, every)], part.schema.field(at).type)
                cells = [[{"kind": LABELS[k], "start": a, "end": b, "base": own} for a, b, k, own in s] for s in every]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(cells, _SPANS_ARROW)], [*part.schema.names, "pii"])

    return rest.mapInArrow(tidy(run), schema)


def redact(text: str, spans: list[tuple]) -> str:
    """``text`` with each run of overlapping spans (sorted by start) replaced by ``<KIND>``."""
    out, done, k = [], 0, 0
    while k < len(spans):
        start, end, kind = spans[k][:3]
        while k < len(spans) and spans[k][0] < end:
            end = max(end, spans[k][1])
            k += 1
        out += [text[done:start], f"<{LABELS[kind].upper()}>"]
        done = end
    return "".join([*out, text[done:]])


def span_text(spans: Column, base_only: bool = False) -> Column:
    """kind:start:end of the spans, joined by commas."""
    chosen = F.filter(spans, lambda s: s["base"]) if base_only else spans
    return F.array_join(F.transform(chosen, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
