"""Job plans and the catalog of registered queries."""
