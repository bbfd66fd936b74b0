"""Table materialisation."""
