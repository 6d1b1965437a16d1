"""Where tables lie: locations, connections, file systems, the transaction log and its snapshots."""
