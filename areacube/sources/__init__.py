"""Table readers (SRC1-SRC7)."""
