"""Order, shipment and fulfilment analytics as Spark DataFrame transformations."""
