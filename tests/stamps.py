"""Time stamps of the hand-made cases."""

from datetime import datetime


def at(text: str) -> datetime:
    return datetime.fromisoformat(text)
