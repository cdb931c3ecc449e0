"""Writers: snapshot folders, history tables with a current view, keyed tables, audit."""
