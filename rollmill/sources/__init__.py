"""Where rows come from: text records, the rollup store, Kafka, manifests."""
