"""Part of winnowry."""
