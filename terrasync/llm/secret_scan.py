"""Secret scans over a trigram inverted index.

Each rule's pattern is turned into a Boolean query over trigrams that every match must contain. Each
Spark task indexes its rows block by block: a block's postings (trigram -> rows) are intersected and
united as the query says, and only the candidate rows are verified with the pattern. A rule without
mandatory trigrams has no query, so its pattern runs over every row. No text is shuffled.

The index folds ASCII letters to lower case, which can add candidates but never loses one.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

try:
    from re import _constants as rc, _parser as rp
except ImportError:  # before Python 3.11
    import sre_constants as rc
    import sre_parse as rp


@dataclass(frozen=True)
class Rule:
    """A kind of secret: leftmost non-overlapping matches of pattern; group `tested` needs min_len characters."""

    kind: str
    pattern: str
    tested: int = 0
    min_len: int = 0
    ignore_case: bool = False

    def compiled(self) -> re.Pattern:
        return re.compile(self.pattern, re.A | (re.I if self.ignore_case else 0))


BASE_RULES = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6, True),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]+", 0, 24),
)
#: What may stand between a key's BEGIN and END line: breaks (escaped ones, too), header lines, base64, and one short line of it or a checksum at the end. Prose may not.
_BREAK = r"(?:[\x20\x09-\x0D]|\\[nrt])"
_BODY = rf"(?:{_BREAK}+(?:[A-Z][A-Za-z]+(?:-[A-Za-z]+)?:[^\n\\]*|[A-Za-z0-9+/]{{16,}}=*))*(?:{_BREAK}+[A-Za-z0-9+/]{{1,63}}=*)?(?:{_BREAK}+=[A-Za-z0-9+/]{{4}})?{_BREAK}*"
#: Further well-known credential shapes (fixed values: the formats their issuers publish). A private key reaches to
#: its END line over header and base64 lines or, where none comes, over the base64 lines that follow. A web token is looked for where a run of
#: its characters begins, so a text of many beginnings is read once.
EXTRA_RULES = (
    Rule("private_key", r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----(?:" + _BODY + r"-----END (?:[A-Z]+ )*PRIVATE KEY-----|(?:[\x20\x09-\x0D]+[A-Za-z0-9+/]{16,}=*)*)"),
    Rule("code_host", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat_bot", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("web_token", r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("pgp_key", r"-----BEGIN PGP PRIVATE KEY BLOCK-----(?:" + _BODY + r"-----END PGP PRIVATE KEY BLOCK-----)?"),
    Rule("session_access", r"ASIA[A-Z0-9]{16,}"),
    Rule("code_host_fine", r"github_pat_[A-Za-z0-9_]{22,}"),
    Rule("code_host_own", r"glpat-[A-Za-z0-9_-]{20,}"),
    Rule("maps_key", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("cloud_login", r"ya29\.[A-Za-z0-9_-]{20,}"),
    Rule("payment", r"[rs]k_(?:live|test)_[A-Za-z0-9]{16,}"),
    Rule("mail_sender", r"SG\.[A-Za-z0-9_-]{16,}\.[A-Za-z0-9_-]{16,}"),
    Rule("mail_gateway", r"key-[0-9a-f]{32}"),
    Rule("package_js", r"npm_[A-Za-z0-9]{36,}"),
    Rule("package_py", r"pypi-[A-Za-z0-9_-]{16,}"),
    Rule("chat_hook", r"hooks\.slack\.com/services/[A-Za-z0-9/]{20,}"),
    Rule("shop", r"shp(?:at|ca|pa|ss)_[0-9a-fA-F]{32,}"),
    Rule("cloud_droplet", r"do[opr]_v1_[0-9a-f]{64}"),
    Rule("vault", r"hvs\.[A-Za-z0-9_-]{24,}"),
    Rule("tracker", r"lin_api_[A-Za-z0-9]{32,}"),
    Rule("model_hub", r"hf_[A-Za-z]{30,}"),
    Rule("data_platform", r"dapi[0-9a-f]{32}"),
    Rule("storage_account", r"AccountKey=[A-Za-z0-9+/]{40,}=*"),
    Rule("database_url", r"(?:postgres|postgresql|mysql|mongodb|redis|amqp)://[^\x20\x09-\x0D:/@]{1,100}:[^\x20\x09-\x0D:/@]{1,100}@"),
    Rule("basic_login", r"Authorization: Basic [A-Za-z0-9+/]{16,}=*"),
    Rule("bearer_login", r"Authorization: Bearer [A-Za-z0-9._-]{20,}"),
    Rule("age_key", r"AGE-SECRET-KEY-1[0-9A-Z]{50,}"),
)
RULES = BASE_RULES + EXTRA_RULES

#: Bytes of one block of the index; only speed and memory (some 20 times as much) depend on it.
BLOCK_BYTES = 2 << 20
_FEW = 64


# ---------------------------------------------------------------- trigram queries
# A query is None (no condition), or ("and" | "or", frozenset of queries and trigrams).


def _join(op: str, parts: list) -> object:
    if op == "or" and any(p is None for p in parts):
        return None
    kept = {p for p in parts if p is not None}
    if op == "or":  # an alternative that asks for more than another adds nothing
        asked = {p: p[1] if isinstance(p, tuple) and p[0] == "and" else {p} for p in kept}
        kept = {p for p in kept if not any(asked[q] < asked[p] for q in kept)}
    if not kept:
        return None
    return next(iter(kept)) if len(kept) == 1 else (op, frozenset(kept))


def _grams(strings: set[bytes]) -> object:
    """What a text must hold if it holds one of these strings."""
    return _join("or", [_join("and", [s[i : i + 3] for i in range(len(s) - 2)]) for s in strings])


def _chars(items) -> set[bytes] | None:
    """The folded strings a character class stands for, if they are few and ASCII."""
    out: set[int] = set()
    for op, arg in items:
        if op is rc.LITERAL:
            out.add(arg)
        elif op is rc.RANGE and arg[1] - arg[0] < _FEW:
            out.update(range(arg[0], arg[1] + 1))
        else:
            return None
    return {chr(c).lower().encode() for c in out} if max(out, default=0) < 128 and len(out) <= _FEW // 8 else None


def _walk(nodes) -> object:
    """The query of a sequence: literal stretches become strings, which alternatives multiply while they are few."""
    found, run = [], {b""}

    def flush():
        nonlocal run
        found.append(_grams(run))
        run = {b""}

    def extend(strings: set[bytes] | None):
        nonlocal run
        if strings is None:
            flush()
        elif len(run) * len(strings) > _FEW:
            flush()
            run = strings
        else:
            run = {a + b for a in run for b in strings}

    for op, arg in nodes:
        if op is rc.LITERAL:
            extend({chr(arg).lower().encode()} if arg < 128 else None)
        elif op is rc.IN:
            extend(_chars(arg))
        elif op is rc.SUBPATTERN or op is getattr(rc, "ATOMIC_GROUP", object()):
            extend(exact := _exact(inner := arg[-1] if op is rc.SUBPATTERN else arg))
            if exact is None:
                found.append(_walk(inner))
        elif op is rc.BRANCH:
            extend(exact := _exact([(op, arg)]))
            if exact is None:
                found.append(_join("or", [_walk(x) for x in arg[1]]))
        elif op in (rc.MAX_REPEAT, rc.MIN_REPEAT):
            low, high, inner = arg
            extend(exact := _exact([(op, arg)]))
            if exact is None and low:
                found.append(_walk(inner))
        else:
            flush()
    flush()
    return _join("and", found)


def _exact(nodes) -> set[bytes] | None:
    """All strings a sequence matches, folded, or None if they are many."""
    run = {b""}
    for op, arg in nodes:
        if op is rc.LITERAL and arg < 128:
            more = {chr(arg).lower().encode()}
        elif op is rc.IN:
            more = _chars(arg)
        elif op is rc.SUBPATTERN:
            more = _exact(arg[-1])
        elif op is rc.BRANCH:
            each = [_exact(x) for x in arg[1]]
            more = None if None in each else set().union(*each)
        elif op in (rc.MAX_REPEAT, rc.MIN_REPEAT) and arg[1] is not rc.MAXREPEAT and arg[1] <= 4:
            once = _exact(arg[2])
            more = None if once is None else set()
            for n in range(arg[0], arg[1] + 1) if once is not None else ():
                power = {b""}
                for _ in range(n):
                    power = {a + b for a in power for b in once}
                more |= power
        else:
            more = None
        if more is None or len(run) * len(more) > _FEW:
            return None
        run = {a + b for a in run for b in more}
    return run


@lru_cache(maxsize=256)
def trigram_query(pattern: str) -> object:
    """The Boolean trigram query that every text with a match satisfies; None if there is none."""
    return _walk(rp.parse(pattern))


def _trigrams(query) -> set[bytes]:
    if query is None:
        return set()
    return {query} if isinstance(query, bytes) else set().union(*(_trigrams(p) for p in query[1]))


# ---------------------------------------------------------------- index of a block

_FOLD = np.arange(256, dtype=np.uint32)
_FOLD[65:91] += 32


def _code(gram: bytes) -> int:
    return gram[0] << 16 | gram[1] << 8 | gram[2]


@lru_cache(maxsize=4)
def _wanted(grams: tuple[bytes, ...]) -> np.ndarray:
    out = np.zeros(1 << 24, bool)
    out[[_code(g) for g in grams]] = True
    return out


class BlockIndex:
    """Postings of the rules' trigrams over the texts of one block."""

    def __init__(self, texts: list[bytes], grams: list[bytes]):
        self.rows = np.arange(len(texts))
        self.postings: dict[bytes, np.ndarray] = {}
        joined = np.frombuffer(b"\0\0".join(texts), np.uint8)
        if len(joined) < 3 or not grams:
            return
        folded = _FOLD[joined]
        codes = folded[:-2] << 16 | folded[1:-1] << 8 | folded[2:]
        at = np.flatnonzero(_wanted(tuple(grams))[codes])
        starts = np.cumsum([0] + [len(t) + 2 for t in texts[:-1]])
        rows, codes = np.searchsorted(starts, at, "right") - 1, codes[at]
        for g in grams:
            self.postings[g] = np.unique(rows[codes == _code(g)])

    def candidates(self, query) -> np.ndarray:
        if query is None:
            return self.rows
        if isinstance(query, bytes):
            return self.postings.get(query, self.rows[:0])
        lists = sorted((self.candidates(p) for p in query[1]), key=len)
        out = lists[0]
        for x in lists[1:]:
            out = np.intersect1d(out, x, True) if query[0] == "and" else np.union1d(out, x)
            if query[0] == "and" and not len(out):
                break
        return out


def _blocks(texts: list[str]) -> Iterator[tuple[int, list[bytes]]]:
    start, block, size = 0, [], 0
    for i, t in enumerate(texts):
        block.append(b := t.encode("utf-8", "surrogatepass"))
        size += len(b)
        if size >= BLOCK_BYTES:
            yield start, block
            start, block, size = i + 1, [], 0
    if block:
        yield start, block


def find(texts: list[str], rules: tuple[Rule, ...]) -> list[list[tuple[int, int, int]]]:
    """For each text its spans (start, kind's place in rules, end), in order; code points, end exclusive."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    queries = [trigram_query(r.pattern) for r in rules]
    compiled = [r.compiled() for r in rules]
    grams = sorted(set().union(*map(_trigrams, queries)))
    for first, block in _blocks(texts):
        index = BlockIndex(block, grams)
        for k, (rule, query, pattern) in enumerate(zip(rules, queries, compiled, strict=True)):
            for row in index.candidates(query).tolist():
                for m in pattern.finditer(texts[first + row]):
                    if len(m[rule.tested]) >= rule.min_len:
                        out[first + row].append((m.start(), k, m.end()))
    for spans in out:
        spans.sort()
    return out


def scan_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Spans of secrets in every whole text.

    Returns id_col and secrets, an array of (start, end, kind) ordered by start, then kind as listed in
    rules. A null or empty text has no secrets; repeated rows are each scanned; other columns are ignored;
    an empty table gives an empty result.
    """
    one = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    kinds = [r.kind for r in rules]

    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string())]))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = find([t or "" for t in b.column("text").to_pylist()], rules)
            spans = pa.array([[{"start": s, "end": e, "kind": kinds[k]} for s, k, e in x] for x in found], span)
            yield pa.RecordBatch.from_arrays([b.column("id"), spans], ["id", "secrets"])

    kind = one.schema["id"].dataType.simpleString()
    return one.mapInArrow(each, f"id {kind}, secrets array<struct<start:bigint,end:bigint,kind:string>>").withColumnRenamed("id", id_col)


_KEY_BEGIN = re.compile(r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----")
_KEY_END = re.compile(r"-----END (?:[A-Z]+ )*PRIVATE KEY-----")
_KEY_GAP = re.compile(r"""(?:\s|\\+[nrt]|[>"',])*""")
_KEY_HEADER = re.compile(r"(?:Proc-Type|DEK-Info|Key-Info|MIC-Info|Content-Domain|Comment):[^\n\\]*")
_KEY_BASE64 = re.compile(r"[A-Za-z0-9+/]+=*")
_KEY_BREAK, _KEY_EOL = re.compile(r"[\r\n]|\\[nr]"), re.compile(r"""[ \t]*(?:[\r\n\\"']|\Z)""")
#: Characters from which a run of base64 counts as a key's whether or not it has a line of its own.
_KEY_RUN = 16


def _key_end(text: str, at: int, stop: int) -> int:
    """Where the private key ends whose first line ends at `at`; the next key's first line starts at `stop`.

    That is behind the header and base64 lines that follow, and the END line behind these; prose is no part of a key. In a
    text without line breaks long runs of base64 are lines, and the run behind them is the last.
    """
    end, long = at, False
    while True:
        start = _KEY_GAP.match(text, end, stop).end()
        if m := _KEY_END.match(text, start, stop):
            return m.end()
        if m := _KEY_HEADER.match(text, start, stop):
            end = m.end()
        elif m := _KEY_BASE64.match(text, start, stop):
            run = m.end() - start >= _KEY_RUN
            if not run and not (_KEY_EOL.match(text, m.end(), stop) if _KEY_BREAK.search(text, end, start) else long):
                return end
            end, long = m.end(), run
        else:
            return end


def _whole_keys(text: str, spans: list[tuple[int, int, int]], kinds: list[str]) -> list[tuple[int, int, int]]:
    """Spans of private keys reach over whole bodies: header lines, short last lines and escaped breaks, which the
    rule leaves where the END line is missing, go too."""
    out, stop = [], len(text)
    for s, k, e in reversed(spans):
        if kinds[k] == "private_key":
            out.append((s, k, max(e, _key_end(text, _KEY_BEGIN.match(text, s).end(), stop))))
            stop = s
        else:
            out.append((s, k, e))
    return out[::-1]


def _mask(text: str, spans: list[tuple[int, int, int]], kinds: list[str]) -> str:
    """Overlapping spans become one mark, named after the first."""
    merged: list[list[int]] = []
    for s, k, e in spans:
        if merged and s < merged[-1][2]:
            merged[-1][2] = max(merged[-1][2], e)
        else:
            merged.append([s, k, e])
    parts, at = [], 0
    for s, k, e in merged:
        parts += [text[at:s], f"[{kinds[k].upper()} REMOVED]"]
        at = e
    return "".join([*parts, text[at:]])


def redact_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text_col: str = "text", length_col: str | None = "n_chars") -> DataFrame:
    """docs with every secret replaced by a mark; all rows and columns stay, null texts stay null.

    A private key goes with its body and its END line. length_col, where the table has it, is set to the new number of code points of changed texts.
    """
    kinds = [r.kind for r in rules]
    names = docs.columns
    sized = length_col if length_col in names else None

    at = names.index(text_col)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(at).to_pylist()
            found = find([t or "" for t in texts], rules)
            if any(found):
                masked = [_mask(t, _whole_keys(t, x, kinds), kinds) if x else t for t, x in zip(texts, found, strict=True)]
                columns = b.columns
                columns[at] = pa.array(masked, b.schema.types[at])
                if sized:
                    j = names.index(sized)
                    sizes = [len(m) if x else n for m, x, n in zip(masked, found, columns[j].to_pylist(), strict=True)]
                    columns[j] = pa.array(sizes, b.schema.types[j])
                b = pa.RecordBatch.from_arrays(columns, schema=b.schema)
            yield b

    return docs.mapInArrow(each, docs.schema)
