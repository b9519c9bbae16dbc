"""DataFrame operators: voxels, masks, campaigns, embeddings, projection, quality control and the file catalogue."""
