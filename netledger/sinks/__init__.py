"""Writers: detail, totals, dimensions, messages, exports."""
