"""JSON that model answers left in Markdown, found line by line.

A scanner walks over the lines with one rule for each kind of opening line: a JSON fence, a bare
``"body_text"`` line, or a line with one of the other properties.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

# Properties of an answer, and the escapes of its text that are undone.
PROPERTIES = ("tables", "figures", "formulas", "page_number")
BODIES = ("body_text", "content", "text")
UNDONE = (("\\n", "\n"), ("\\t", "\t"), ('\\"', '"'))
FENCE, OPENING, PAGE = "```", "```json", "## Page"


def undone(text: str) -> str:
    for written, meant in UNDONE:
        text = text.replace(written, meant)
    return text


def string_at(text: str, at: int) -> str:
    """The JSON string whose quote stands before ``at``, up to its closing quote or the end; escapes as written."""
    end = at
    while end < len(text) and text[end] != '"':
        end += 2 if text[end] == "\\" else 1
    return text[at:end]


def property_value(line: str, names: tuple[str, ...]) -> str | None:
    """What follows ``"name":`` at the start of a line for one of the names; None for any other line."""
    bare = line.lstrip()
    for name in names:
        head = f'"{name}":'
        if bare.startswith(head):
            return bare[len(head) :].lstrip()
    return None


def answer_body(block: str) -> str | None:
    """The text of a whole JSON answer: its body, else nothing; None if it is no JSON."""
    try:
        value = json.loads(block)
    except ValueError:
        return None
    for name in BODIES if isinstance(value, dict) else ():
        if name in value:  # an empty body is a body
            body = value[name]
            return body.replace("\\n", "\n") if isinstance(body, str) else str(body)
    return ""


@dataclass
class Scanner:
    lines: list[str]
    at: int = 0
    fixes: int = 0
    out: list[str] = field(default_factory=list)

    def run(self) -> None:
        while self.at < len(self.lines):
            line = self.lines[self.at]
            if not (line.rstrip().endswith(OPENING) and (self.whole_block() or self.cut_off() or self.bare_opening())):
                if not (self.body_line() or self.residue()):
                    self.out.append(line)
                    self.at += 1

    def take(self, until: int, text: str | None) -> bool:
        """Go on at a line; what was passed becomes ``text``, or nothing at all."""
        if text is not None:
            self.out.append(text)
        self.at = until
        self.fixes += 1
        return True

    def whole_block(self) -> bool:
        close = next((k for k in range(self.at + 1, len(self.lines)) if self.lines[k].startswith(FENCE)), None)
        if close is None:
            return False
        body = answer_body("\n".join(self.lines[self.at + 1 : close]))
        if body is None:
            return False
        before = self.lines[self.at].rstrip().removesuffix(OPENING)
        return self.take(close + 1, before + body + self.lines[close].removeprefix(FENCE))

    def cut_off(self) -> bool:
        """An answer that begins with its page number and never ends: it reaches to the next page."""
        following = self.lines[self.at + 1 : self.at + 3]
        number = property_value(following[1], ("page_number",)) if len(following) == 2 and following[0].strip() == "{" else None
        if not number or not number[0].isdigit() or "," not in number:
            return False
        end = next((k for k in range(self.at + 1, len(self.lines) - 1) if not self.lines[k] and self.lines[k + 1].startswith(PAGE)), len(self.lines))
        block = "\n".join(self.lines[self.at : end])
        head, _, rest = block.partition('"body_text":')
        quote = rest.find('"')
        text = undone(string_at(rest, quote + 1)) if quote >= 0 and not rest[:quote].strip() else ""
        return self.take(end, self.lines[self.at].rstrip().removesuffix(OPENING) + text)

    def bare_opening(self) -> bool:
        k = self.at + 1
        while k < len(self.lines) and not self.lines[k].strip():
            k += 1
        if k >= len(self.lines) or self.lines[k].strip() != "{" or k + 1 < len(self.lines) and self.lines[k + 1].strip():
            return False
        return self.take(k + 1, self.lines[self.at].rstrip().removesuffix(OPENING))

    def body_line(self) -> bool:
        """A body without its object: its text goes on to the next page or fence."""
        value = property_value(self.lines[self.at], ("body_text",))
        if value is None or not value.startswith('"'):
            return False
        end = next((k for k in range(self.at + 1, len(self.lines)) if self.lines[k].startswith((PAGE, FENCE))), len(self.lines))
        parts = [value[1:], *(line.removesuffix('",') for line in self.lines[self.at + 1 : end])]
        return self.take(end, undone("\n".join(parts)).rstrip().rstrip('",'))

    def residue(self) -> bool:
        value = property_value(self.lines[self.at], PROPERTIES)
        return value is not None and bool(value) and (value[0] == "[" or value[0].isdigit()) and self.take(self.at + 1, None)


def without_json(text: str) -> tuple[str, int]:
    """The text without the JSON around answers' bodies, and how many places changed."""
    scanner = Scanner(text.split("\n"))
    scanner.run()
    return "\n".join(scanner.out), scanner.fixes
