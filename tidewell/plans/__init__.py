"""Jobs built from several operators."""
