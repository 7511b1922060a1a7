"""Plain Python forms of the operators, for small tables."""

from __future__ import annotations

import math
import re
import zlib
from collections import defaultdict

from smeltery.llm.pii import LENGTHS


def shingle_set(text: str | None) -> frozenset:
    words = re.findall(r"\w+", (text or "").lower())
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def near_classes(rows: list[tuple[int, str | None]]) -> dict[int, tuple[int, int, int]]:
    """doc_id to (class, links to documents, links to other sets)."""
    sets = {i: shingle_set(t) for i, t in rows}
    parent = {i: i for i in sets}

    def top(i: int) -> int:
        while parent[i] != i:
            i = parent[i]
        return i

    links: dict[int, int] = defaultdict(int)
    others: dict[int, set] = defaultdict(set)
    names = list(sets)
    for x, a in enumerate(names):
        for b in names[x + 1 :]:
            common = len(sets[a] & sets[b])
            if common and common >= 0.8 * (len(sets[a]) + len(sets[b]) - common) - 1e-9:
                links[a] += 1
                links[b] += 1
                if sets[a] != sets[b]:
                    others[a].add(sets[b])
                    others[b].add(sets[a])
                low, high = sorted((top(a), top(b)))
                parent[high] = low
    return {i: (top(i), links[i], len(others[i])) for i in sets}


def line_dedup(rows: list[tuple[int, str | None]]) -> dict[int, str | None]:
    seen: set[tuple[str, ...]] = set()
    out: dict[int, str | None] = {}
    for i, text in sorted(rows):
        if text is None:
            out[i] = None
            continue
        lines = text.split("\n")
        gone: set[int] = set()
        for at in range(len(lines) - 2):
            window = tuple(lines[at : at + 3])
            if not "".join(x.strip(" ") for x in window):
                continue
            if window in seen:
                gone |= {at, at + 1, at + 2}
            seen.add(window)
        out[i] = "\n".join(x for at, x in enumerate(lines) if at not in gone) if gone else text
    return out


_MASKS = {
    "IBAN": "",
    "EMAIL": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "PHONE": r"\+[0-9][ ().0-9-]+[0-9]",
    "CARD": r"[0-9](?:[ -]?[0-9])+",
    "IP": r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+",
}
_SCORES = {"EMAIL": 0.9, "IP": 0.6, "CARD": 0.7, "PHONE": 0.6, "IBAN": 0.8}
_WORDS = {
    "EMAIL": "mail|contact|write|kontakt|correo",
    "IP": "ip|address|host|server|adresse",
    "CARD": "card|visa|credit|karte|carte|tarjeta",
    "PHONE": "phone|call|tel|fax|mobile",
    "IBAN": "iban|account|bank|konto|compte|cuenta",
}
_EXAMPLES = "example sample dummy fictitious beispiel muster exemple fictif ejemplo ficticio".split()
_SIZES = {name: n for n, names in LENGTHS.items() for name in names.split()}


def _account_end(text: str, at: int) -> int | None:
    """Where an account number that starts here ends, block by block."""

    def upper(i: int, n: int) -> bool:
        part = text[i : i + n]
        return len(part) == n and all(c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789" for c in part)

    def blocks(i: int, n: int) -> tuple[int, int]:
        done = 0
        while done < n:
            start = i + (text[i : i + 1] == " ")
            if not upper(start, 4):
                break
            i, done = start + 4, done + 1
        return i, done

    if not re.match("[A-Z]{2}[0-9]{2}", text[at : at + 4]):
        return None
    size = _SIZES.get(text[at : at + 2])
    if size:
        end, done = blocks(at + 4, size // 4 - 1)
        if done == size // 4 - 1:
            if size % 4:
                start = end + (text[end : end + 1] == " ")
                end = start + size % 4 if upper(start, size % 4) else None
            if end is not None and not re.match("[A-Za-z0-9]", text[end : end + 1]):
                return end
    end, done = blocks(at + 4, 7)
    if done < 2:
        return None
    start = end + (text[end : end + 1] == " ")
    more = next((n for n in (3, 2, 1) if upper(start, n)), 0)
    return start + more if more else end


def _found(kind: str, text: str) -> list[tuple[int, int]]:
    if kind != "IBAN":
        return [m.span() for m in re.finditer(_MASKS[kind], text)]
    out, at = [], 0
    while at < len(text):
        end = _account_end(text, at)
        if end is not None:
            out.append((at, end))
        at = at + 1 if end is None else end
    return out


def scored(kind: str, text: str) -> list[tuple[int, int, float]]:
    """Confirmed spans that count, with the score the words around them give."""
    found, out = _found(kind, text), []
    for i, (a, b) in enumerate(found):
        start = found[i - 1][1] if i else 0
        end = found[i + 1][0] if i + 1 < len(found) else len(text)
        around = [text[max(start, a - 40) : a].lower(), text[b : min(end, b + 40)].lower()]
        score = _SCORES[kind] + 0.1 * any(re.search(_WORDS[kind], t) for t in around)
        joined = " ".join(around)
        score -= 0.4 * any(re.search(rf"(?:^|[^a-z@.]){w}(?:[^a-z@.]|$)", joined) for w in _EXAMPLES)
        if valid(kind, text[a:b]) and (kind != "IBAN" or round(score, 2) >= 0.5):
            out.append((a, b, round(score, 2)))
    return out


def valid(kind: str, match: str) -> bool:
    digits = [int(c) for c in match if c.isdigit()]
    if kind == "IBAN":
        plain = match.replace(" ", "")
        return int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1
    if kind == "PHONE":
        return 9 <= len(digits) <= 15
    if kind == "CARD":
        doubled = [d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(reversed(digits))]
        return 13 <= len(digits) <= 19 and sum(doubled) % 10 == 0
    if kind == "IP":
        return all(int(p) <= 255 for p in match.split("."))
    return True


def spans(text: str | None, kinds: tuple[str, ...]) -> list[tuple[str, int, int]]:
    return [(k.lower(), a, b) for k in kinds for a, b, _ in scored(k, text or "")]


def masked(text: str | None) -> str | None:
    for kind in _MASKS:
        for a, b, _ in reversed(scored(kind, text or "")):
            text = f"{text[:a]}[{kind}]{text[b:]}"
    return text


def check_packing(pieces: list, ids: dict[int, list[int]], window: int = 4096) -> float:
    """Assert the contract of packed pieces; returns the share of padding."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p["doc_id"]].append(p)
        by_sequence[p["sequence_id"]].append(p)
    assert set(by_doc) == set(ids)
    for i, parts in by_doc.items():
        whole, at = ids[i], 0
        for p in sorted(parts, key=lambda p: p["start"]):
            assert p["start"] == at and p["doc_tokens"] == len(whole)
            raw = b"".join(x.to_bytes(4, "little") for x in whole[at : at + p["length"]])
            assert p["ids_crc32"] == zlib.crc32(raw)
            at += p["length"]
        assert at == len(whole)
    padding = total = 0
    for parts in by_sequence.values():
        at = 0
        for p in sorted(parts, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= window
        padding += 0 if math.log2(at).is_integer() else window - at
        total += at
    return padding / total
