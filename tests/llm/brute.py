"""The contracts of the operators, computed plainly, one document at a time."""

from __future__ import annotations

import hashlib
import re

FORMS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
KINDS = list(FORMS)


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (1 + i % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def base_spans(text: str | None) -> list[tuple[int, int, str]]:
    """(start, kind number, end) by start and kind."""
    out = []
    for number, (kind, form) in enumerate(FORMS.items()):
        for m in re.finditer(form, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            good = {
                "email": True,
                "ip": kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")),
                "card": 12 <= len(digits) <= 19 and _luhn(digits),
                "phone": 9 <= len(digits) <= 15,
            }[kind]
            if good:
                out.append((m.start(), number, m.end()))
    return sorted(out)


def written(spans) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def base_sha256(text: str | None) -> str:
    return hashlib.sha256(written(base_spans(text)).encode()).hexdigest()


def removed(texts: list[str | None], width: int = 200) -> list[list[tuple[int, int]]]:
    """Maximal removed byte runs of each text."""
    seen: dict[bytes, int] = {}
    raw = [(t or "").encode() for t in texts]
    for b in raw:
        for p in range(len(b) - width + 1):
            w = b[p : p + width]
            seen[w] = seen.get(w, 0) + 1
    out = []
    for b in raw:
        runs: list[tuple[int, int]] = []
        for p in range(len(b) - width + 1):
            if seen[b[p : p + width]] > 1:
                if runs and p <= runs[-1][1]:
                    runs[-1] = (runs[-1][0], p + width)
                else:
                    runs.append((p, p + width))
        out.append(runs)
    return out
