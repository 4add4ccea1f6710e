"""Writers with an explicit rule for rows that exist already."""
