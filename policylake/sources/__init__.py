"""Where rows come from and where they go."""
