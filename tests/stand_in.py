"""A deterministic stand-in for a hosted model."""

from __future__ import annotations

import json
import re

_PAGE_HEAD = re.compile(r"=== PAGE (\d+) ===\n")
_FIRST_OF = re.compile(r"^([Pp]age\s+1\s*(/|of)|-\s*1\s*/)")


def cue_predictor(prompt: str, max_tokens: int | None = None) -> str:
    """Deterministic stand-in for a hosted model, for tests and dry runs.

    Reads the page blocks of a boundary prompt and answers with the pages whose
    page indicator reads "page 1 of N" or whose invoice number differs from the
    previous page's, in the JSON form the prompt asks for.
    """
    parts = _PAGE_HEAD.split(prompt)
    starts, prev_inv = [], None
    for i in range(1, len(parts) - 1, 2):
        page, body = int(parts[i]), parts[i + 1]
        fields = dict(line.split(": ", 1) for line in body.split("\n") if ": " in line)
        ind, inv = fields.get("page_indicator", ""), fields.get("invoice_number", "")
        if page == 1 or _FIRST_OF.match(ind) or (inv and prev_inv and inv != prev_inv):
            starts.append(page)
        prev_inv = inv or prev_inv
    return json.dumps({"predicted_starts": starts})
