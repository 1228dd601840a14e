"""Writers: delivery CSV folders and the stored route table."""
