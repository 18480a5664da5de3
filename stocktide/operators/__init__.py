"""DataFrame operators: windows, calendar, selection, preparation, models, scores."""
