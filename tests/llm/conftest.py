import pytest

from tidemart.llm import rounds


@pytest.fixture
def many_chunks(monkeypatch):
    """Chunks and ranges so small that even a few texts need many."""
    monkeypatch.setattr(rounds, "CHUNK_BYTES", 600)
    monkeypatch.setattr(rounds, "RANGE_BYTES", 300)
