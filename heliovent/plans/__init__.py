"""Jobs: whole stages from input paths to output paths."""
