"""Writers and export formats."""
