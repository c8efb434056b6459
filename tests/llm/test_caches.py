from __future__ import annotations

from framelake.llm import caches


def test_one_owner_at_a_time():
    caches._held.clear()
    dropped = []
    caches.claim("a", lambda: dropped.append("a"))
    caches.claim("a", lambda: dropped.append("a"))
    assert dropped == []
    caches.claim("b", lambda: dropped.append("b"))
    assert dropped == ["a"] and list(caches._held) == ["b"]
    caches._held.clear()
