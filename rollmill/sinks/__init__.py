"""Where rows go: store lines, micro-batches, snapshots, manifests."""
